import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reachmart.session import local_session  # noqa: E402

# Hand-sized inputs with known results: a customer who only got a refund, one without orders
# or an answer, one who only looked around, orders and visits on the edges of the windows as
# seen from 2024-06-30, and an order without a customer.
SEEDS = {
    "customers": [
        "customer_id,email,first_name,last_name,created_at,country,marketing_opt_in,nps_score",
        "10,Mia@Shop.example,Mia,Okoro,2024-02-11,NL,1,9.0",
        "11,noah@shop.example,Noah,Berg,2024-03-02,NL,,5.0",
        "12,lia@shop.example,Lia,Costa,2024-05-20,PT,1,",
        "13,omar@shop.example,Omar,Haddad,2024-04-15,SE,1,2.0",
        "14,ines@shop.example,Ines,Prat,2024-06-01,PT,0,8.0",
        "15,tom@shop.example,Tom,Ek,2024-06-10,SE,1,7.0",
    ],
    "orders": [
        "order_id,customer_id,order_ts,status,amount",
        "501,10,2024-05-06 08:00:00,paid,90.2",
        "502,10,2024-06-10 12:30:00,paid,70.0",
        "503,11,2024-04-01 00:00:00,paid,33.3",
        "504,13,2024-06-05 19:45:00,refunded,250.0",
        "505,14,2024-06-12 07:15:00,paid,160.0",
        "506,14,2024-06-17 07:15:00,paid,15.5",
        "507,,2024-06-18 10:00:00,paid,5.0",
    ],
    "web_events": [
        "event_id,customer_id,event_type,event_ts,session_id",
        "9001,10,view,2024-06-25 09:00:00,a1",
        "9002,15,view,2024-06-26 10:00:00,a2",
        "9003,15,cart,2024-06-27 10:05:00,a2",
        "9004,13,view,2024-06-02 12:00:00,a3",
        "9005,14,view,2024-05-30 23:59:59,a4",
        "9006,11,view,2024-05-31 00:00:00,a5",
    ],
    "ad_spend": [
        "date,channel,campaign,spend",
        "2024-05-01,search,spring,120.5",
        "2024-05-09,video,spring,80.25",
        "2024-06-01,search,summer,310.0",
    ],
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def seed_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("seeds")
    for name, lines in SEEDS.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.fixture()
def column(spark):
    """Evaluates a column expression over rows of one or more input columns."""

    def run(rows, schema, expression):
        frame = spark.createDataFrame([(number, *row) for number, row in enumerate(rows)], f"number int, {schema}")
        return [row[0] for row in frame.orderBy("number").select(expression).collect()]

    return run


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
