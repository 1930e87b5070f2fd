"""The four business sources derived from the TPC-H-like benchmark tables.

Every row of orders, events, lineitem and customer is used. The ``raw_*`` frames hold text
only, as a landed file would; the others are the typed Bronze shape.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.schemas import MONEY


@dataclass(frozen=True)
class DriverTables:
    spark: SparkSession
    folder: str
    _opened: dict[str, DataFrame] = field(default_factory=dict)

    def _table(self, name: str) -> DataFrame:
        # Opening a table reads a footer for its schema: once per table is enough.
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def players(self) -> DataFrame:
        key = F.col("c_custkey")
        mail = F.concat("c_name", F.lit("@mail.com"))
        offset = ((key % 900) * (key % 900) % 900).cast("int")
        return (
            self._table("customer").join(self._table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.concat(F.lit("pl_"), key).alias("player_id"),
                F.when(key % 5 == 0, F.upper(mail)).otherwise(F.lower(mail)).alias("email"),
                F.col("n_name").alias("city"),
                F.date_add(F.lit("1995-01-01").cast("date"), offset).alias("created_at"),
            )
        )

    def transactions(self) -> DataFrame:
        return self._table("orders").select(
            F.concat(F.lit("tx_"), "o_orderkey").alias("transaction_id"),
            F.concat(F.lit("pl_"), "o_custkey").alias("player_id"),
            F.when(F.col("o_orderstatus") == "F", "deposit").when(F.col("o_orderstatus") == "O", "withdraw")
            .otherwise("bet").alias("transaction_type"),
            (F.floor(F.col("o_totalprice") / 1000) + 1).cast(MONEY).alias("amount"),
            F.col("o_orderdate").cast("timestamp").alias("txn_ts"),
        )

    def sessions(self) -> DataFrame:
        return self._table("events").select(
            F.concat(F.lit("ss_"), "event_id").alias("session_id"),
            F.concat(F.lit("pl_"), "user_id").alias("player_id"),
            F.concat(F.lit("10.0.0."), F.get_json_object("props", "$.k")).alias("ip"),
            F.col("event_type").alias("device"),
            F.col("ts").cast("timestamp").alias("session_ts"),
        )

    def affiliate_in_order(self) -> DataFrame:
        """Affiliate rows plus the two columns that stand for their place in the file."""
        claims = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
        # The largest orders are reported under the affiliate's country, all others under the player's.
        nation: Column = F.when(F.col("l_quantity") == 50, F.col("s_nationkey")).otherwise(F.col("c_nationkey"))
        rows = (
            self._table("lineitem")
            .join(self._table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self._table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self._table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .withColumn("nation", nation)
            .join(self._table("nation"), F.col("nation") == F.col("n_nationkey"))
        )
        return rows.select(
            F.concat(F.lit("aff_"), "l_suppkey").alias("affiliate_id"),
            F.concat(F.lit("pl_"), "o_custkey").alias("player_id"),
            F.col("n_name").alias("country"),
            F.col("l_quantity").cast("bigint").alias("clicks"),
            (10 + F.col("l_partkey") % 15).cast("bigint").alias("registrations"),
            F.when(claims, 1 + F.col("l_partkey") % 20).otherwise(0).cast("bigint").alias("ftd"),
            F.round(F.col("l_discount") * 1000).cast(MONEY).alias("cpa_value"),
            F.col("l_orderkey").alias("file_no"),
            F.col("l_linenumber").alias("line_no"),
        )

    def affiliate(self) -> DataFrame:
        return self.affiliate_in_order().drop("file_no", "line_no")

    def _text(self, df: DataFrame, **renamed: str) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(renamed.get(c, c)) for c in df.columns])

    def raw_players(self) -> DataFrame:
        return self._text(self.players())

    def raw_sessions(self) -> DataFrame:
        iso = F.date_format("session_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return self._text(self.sessions().withColumn("session_ts", iso), session_ts="timestamp")

    def raw_transactions(self) -> DataFrame:
        """Small amounts arrive as 'n/a', so that the casts have something to catch."""
        typed = self.transactions().withColumn("txn_ts", F.date_format("txn_ts", "yyyy-MM-dd HH:mm:ss"))
        text = F.when(F.col("amount") <= 5, "n/a").otherwise(F.col("amount").cast("string"))
        return self._text(typed.withColumn("amount", text), transaction_type="type", txn_ts="timestamp")

    def raw_affiliate(self) -> DataFrame:
        """Single-click rows carry a decimal count, which is not an integer."""
        text = F.when(F.col("clicks") == 1, "1.0").otherwise(F.col("clicks").cast("string"))
        return self._text(self.affiliate().withColumn("clicks", text))
