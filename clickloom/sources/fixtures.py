"""Action log, user table and ad log derived from the TPC-H-like test tables.

Every derivation is a projection of ``events`` (plus the small customer, nation and region tables), so
the data grow with the tables and deriving them needs no shuffle of the log. FIXTURES.md describes them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_DAY, LAST_DAY = "1000-01-01", "9999-12-31"
AD_THRESHOLD = 3  # the log is too thin for the usual threshold

# The columns that are used, with their stored types: naming them saves a look into each file's footer.
_SCHEMAS = {
    "events": "ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


@dataclass(frozen=True)
class Fixtures:
    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        self.spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def text_action_log(self) -> DataFrame:
        """The action log as text: dates, times (those of page 7 do not read) and lists with parts that are no ids."""
        log = self.action_log()
        lists = [c for c in log.columns if c.endswith("_ids")]
        noise = F.when(F.col("user_id") % 3 == 0, ",").when(F.col("user_id") % 3 == 1, ", x1,").otherwise("")
        when = F.when(F.col("page_id") == 7, "soon").otherwise(F.date_format("action_time", "yyyy-MM-dd HH:mm:ss"))
        texts = {c: F.concat(F.col(c), noise) for c in lists}
        return log.withColumns({"date": F.col("date").cast("string"), "action_time": when, **texts})

    def action_log(self) -> DataFrame:
        """Visits of a day, a week or 30 days by user, each played back faster from its own start hour."""
        return (
            self.table("events")
            .selectExpr(
                "user_id",
                "event_type",
                "to_date(ts) as date",
                "unix_timestamp(cast(ts as timestamp)) as epoch",
                "cast(get_json_object(props, '$.k') as bigint) as k",
                "element_at(array(1, 7, 30), cast(user_id % 3 as int) + 1) as period",
                "element_at(array(40, 400, 2000), cast(user_id % 3 as int) + 1) as speed",
            )
            .selectExpr("*", "epoch div (86400 * period) as block")
            .selectExpr("*", "block * 86400 * period as first_epoch")
            .selectExpr(
                "date",
                "user_id",
                "concat_ws('_', user_id, period, block) as session_id",
                "k % 10 as page_id",
                "timestamp_seconds(first_epoch + (user_id % 24) * 3600 + (epoch - first_epoch) div speed)"
                " as action_time",
                "case when event_type = 'view' then concat('kw', k % 10) end as search_keyword",
                "if(event_type = 'click', k, -999) as click_category_id",
                "if(event_type = 'click', k * 3 % 100, -999) as click_product_id",
                "case when event_type = 'signup' then concat(k, ',', (k + 7) % 100) end as order_category_ids",
                "case when event_type = 'signup' then concat(k * 3 % 100, ',', (k + 11) % 100) end"
                " as order_product_ids",
                "case when event_type = 'purchase' then concat(k, ',', (k + 7) % 100) end as pay_category_ids",
                "case when event_type = 'purchase' then concat(k * 3 % 100, ',', (k + 11) % 100) end"
                " as pay_product_ids",
                "user_id % 10 as city_id",
            )
        )

    def users(self) -> DataFrame:
        nation = self.table("nation")
        return self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
            "c_custkey as user_id",
            "c_name as username",
            "c_name as name",
            "cast(c_custkey * 7 % 60 as int) as age",
            "c_mktsegment as professional",
            "n_name as city",
            "if(c_custkey % 2 = 0, 'male', 'female') as sex",
        )

    def defective_ad_lines(self) -> DataFrame:
        """The ad log with lines that do not read, by user and time: cut short, without numbers, too large, empty, null; some have more fields."""
        kind = (F.split("line", " ")[3].cast("bigint") + F.unix_millis("ts")) % 17
        line = (
            F.when(kind == 0, F.substring_index("line", " ", 4))
            .when(kind == 1, F.concat(F.lit("x"), "line"))
            .when(kind == 2, F.regexp_replace("line", r" \d+ (\d+)$", " -u $1"))
            .when(kind == 3, F.concat("line", F.lit("99999999999999999999")))
            .when(kind == 4, "")
            .when(kind == 5, None)
            .when(kind == 6, F.concat("line", F.lit(" more fields")))
            .otherwise(F.col("line"))
        )
        return self.ad_lines().select("ts", line.alias("line"))

    def ad_lines(self) -> DataFrame:
        """One log line per event: province is the customer's region, city the nation. ``ts`` comes along for slicing."""
        places = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "c_custkey as user_id",
                "concat_ws(' ', replace(r_name, ' ', '_'), replace(n_name, ' ', '_')) as place",
            )
        )
        events = self.table("events").selectExpr(
            "user_id",
            "cast(ts as timestamp) as ts",
            "cast(get_json_object(props, '$.k') as bigint) % 7 as ad_id",
        )
        return events.join(places, "user_id").selectExpr(
            "ts", "concat_ws(' ', unix_millis(ts), place, user_id, ad_id) as line"
        )
