"""Small hand-built inputs with known answers."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal
from itertools import count

from pyspark.sql import DataFrame, SparkSession

from clickstrata.schemas import TABLES

START = datetime(2026, 6, 1, 10, 0)


def money(value: str | None) -> Decimal | None:
    return None if value is None else Decimal(value)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Hand:
    """Collects rows and turns them into typed DataFrames."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._ids = count(1)
        self._request_ids = count(1)
        self.events: list[dict] = []
        self.requests: list[dict] = []
        self.campaign_rows: list[dict] = []
        self.experiment_rows: list[dict] = []

    def campaign(self, campaign_id, bid="1.00", country="DE", platform="android", **more):
        self.campaign_rows.append(
            {
                "campaign_id": campaign_id,
                "advertiser_id": 1,
                "campaign_name": f"Campaign {campaign_id}",
                "target_country": country,
                "target_platform": platform,
                "target_category": more.get("category", "puzzle"),
                "bid_cpi": money(bid),
                "daily_budget": money("100.00"),
                "status": more.get("status", "active"),
            }
        )

    def experiment(self, experiment_id, variant, name="ranking"):
        self.experiment_rows.append(
            {
                "experiment_id": experiment_id,
                "experiment_name": name,
                "variant": variant,
                "algorithm_name": f"algorithm {variant}",
                "start_date": date(2026, 6, 1),
            }
        )

    def request(self, tracking_id, campaign_id=1, app_id=1, user_id=1, **more):
        row = {
            "ad_request_id": next(self._request_ids),
            "tracking_id": tracking_id,
            "user_id": user_id,
            "app_id": app_id,
            "campaign_id": campaign_id,
            "experiment_id": more.get("experiment_id", 1),
            "request_time": more.get("at", START),
            "country": more.get("country", "DE"),
            "platform": more.get("platform", "android"),
        }
        self.requests.append(row)
        return row

    def event(self, request, event_type, **changes):
        """An event that repeats its request's values unless changed."""
        number = next(self._ids)
        row = {
            "raw_event_id": number,
            "event_id": f"hand_{number}",
            **{
                name: request[name]
                for name in (
                    "tracking_id",
                    "campaign_id",
                    "app_id",
                    "user_id",
                    "country",
                    "platform",
                )
            },
            "event_type": event_type,
            "event_time": request["request_time"] + timedelta(minutes=number),
            "revenue": "0.00",
            "reward_cost": "0.00",
        }
        row.update(changes)
        row["revenue"] = money(row["revenue"])
        row["reward_cost"] = money(row["reward_cost"])
        self.events.append(row)
        return row

    def frame(self, table: str, rows: list[dict]) -> DataFrame:
        schema = TABLES[table].schema
        values = [tuple(row.get(f.name) for f in schema) for row in rows]
        return self.spark.createDataFrame(values, schema)

    @property
    def raw(self) -> DataFrame:
        return self.frame("events_raw", self.events)

    @property
    def ad_requests(self) -> DataFrame:
        return self.frame("ad_requests", self.requests)

    @property
    def campaigns(self) -> DataFrame:
        return self.frame("campaigns", self.campaign_rows)

    @property
    def experiments(self) -> DataFrame:
        return self.frame("experiments", self.experiment_rows)


def seven_requests(spark: SparkSession) -> Hand:
    """Seven requests on four campaigns: repeated steps, no events, broken funnels."""
    hand = Hand(spark)
    hand.campaign(4, "1.75", "AT", "ios")
    hand.campaign(5, "0.90", "US", "android")
    hand.campaign(8, "3.35", "SE", "ios")
    hand.campaign(11, "6.10", "GB", "ios")
    hand.experiment(1, "A")
    hand.experiment(2, "B")
    steps = {
        1: (5, [("impression",), ("click",), ("install",), ("reward", "0.25"), ("reward", "0.15")]),
        2: (11, [("impression",), ("impression",), ("click",)]),
        3: (
            5,
            [
                ("impression",),
                ("click",),
                ("install",),
                ("conversion", "7.50"),
                ("conversion", "2.25"),
            ],
        ),
        4: (4, [("impression",), ("impression",), ("impression",)]),
        5: (8, []),
        6: (8, [("impression",), ("click",), ("install",)]),
        7: (11, [("impression",), ("click",), ("click",)]),
    }
    targets = {row["campaign_id"]: row for row in hand.campaign_rows}
    for number, (campaign_id, events) in steps.items():
        request = hand.request(
            f"trk_hand_{number:03}",
            campaign_id,
            app_id=20 + campaign_id,
            user_id=100 + number,
            country=targets[campaign_id]["target_country"],
            platform=targets[campaign_id]["target_platform"],
            experiment_id=1 + number % 2,
        )
        for event_type, *amount in events:
            paid = {"conversion": "revenue", "reward": "reward_cost"}.get(event_type)
            hand.event(request, event_type, **({paid: amount[0]} if paid else {}))
    return hand


def with_faults(hand: Hand) -> Hand:
    """One more request and nine events: eight faulty ones and a lonely click."""
    by_id = {row["tracking_id"]: row for row in hand.requests}
    first, third, fourth, sixth, seventh = (
        by_id[f"trk_hand_00{n}"] for n in (1, 3, 4, 6, 7)
    )
    hand.event(fourth, "impression", tracking_id=None)
    hand.event(sixth, "install", tracking_id="trk_astray")
    for _ in range(3):
        hand.event(third, "install", event_id="thrice")
    hand.event(first, "impression", user_id=99)
    hand.event(seventh, "click", country="NO")
    hand.event(sixth, "click", app_id=77)
    lonely = hand.request(
        "trk_only_click", 4, app_id=24, user_id=108, country="AT", platform="ios"
    )
    hand.event(lonely, "click")
    return hand
