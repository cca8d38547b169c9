import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardwatch.session import build_session, checkpoint_dir  # noqa: E402

TXN_SCHEMA = ("trans_id string, trans_date timestamp_ntz, amt decimal(10,2), card_num string, "
              "oper_type string, oper_result string, terminal string")
CLIENT_SCHEMA = ("client_id string, last_name string, first_name string, patronymic string, "
                 "passport_num string, passport_valid_to date, phone string")
ACCOUNT_SCHEMA = "account_num string, valid_to date, client string"
CARD_SCHEMA = "card_num string, account_num string"
HIST_SCHEMA = ("terminal_id string, terminal_type string, terminal_city string, terminal_address string, "
               "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg boolean")
SNAP_SCHEMA = "terminal_id string, terminal_type string, terminal_city string, terminal_address string"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="cardwatch-tests", extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s, tempfile.mkdtemp(prefix="cw-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


class Bank:
    """A tiny bank: cards C1..Cn, each on its own account and client."""

    def __init__(self, spark, n=3, passport_valid_to=None, account_valid_to=None, patronymic="P"):
        self.spark = spark
        clients, accounts, cards = [], [], []
        for i in range(1, n + 1):
            pv = (passport_valid_to or {}).get(i)
            av = (account_valid_to or {}).get(i, dt.date(2099, 1, 1))
            pat = patronymic if not isinstance(patronymic, dict) else patronymic.get(i, "P")
            clients.append((f"K{i}", f"Last{i}", f"First{i}", pat, f"DOC{i}", pv, f"+{i}"))
            accounts.append((f"A{i}", av, f"K{i}"))
            cards.append((f"C{i}", f"A{i}"))
        self.clients = spark.createDataFrame(clients, CLIENT_SCHEMA)
        self.accounts = spark.createDataFrame(accounts, ACCOUNT_SCHEMA)
        self.cards = spark.createDataFrame(cards, CARD_SCHEMA)

    def txns(self, rows):
        """rows: (trans_id, 'YYYY-MM-DD HH:MM:SS', amt, card, result, terminal)."""
        from decimal import Decimal
        data = [(i, ts(t), Decimal(str(a)), c, "op", r, term) for i, t, a, c, r, term in rows]
        return self.spark.createDataFrame(data, TXN_SCHEMA)
