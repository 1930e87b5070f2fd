"""Discovery: profile sources before trusting them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.functions.scalars import is_type, one_row, stack_union
from wagerlens.plans.silver import claim_rank
from wagerlens.schemas import MONEY, TOTAL


def _value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for every distinct non-NULL value, as text.

    One shuffle for all columns; counts combine before it, so a dominant value is one row per task.
    """
    long = df.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
        ]))
    )
    return long.where("value is not null").groupBy("column_name", "value").agg(F.count("*").alias("n"))


def _smallest_values(counts: DataFrame, k: int) -> DataFrame:
    """(column_name, heads): the k smallest values of each column, with counts, in order.

    The row_number limit is applied inside each task first, so only k rows per column and task meet.
    """
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    return (
        counts.withColumn("k", rank).where(F.col("k") <= k)
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list(F.struct("k", "value", "n"))).alias("heads"))
    )


def column_profile(df: DataFrame, examples: int = 3, categories_up_to: int = 8) -> DataFrame:
    """Per column: type, rows, NULLs, distinct values, the first `examples`, numeric range.

    Text columns of at most `categories_up_to` values also tell how often each occurs.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    one_pass = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns],
        *[f(c).cast("double").alias(f"{name}_{c}") for c in numeric
          for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))],
    )
    nothing = F.lit(None).cast("double")
    basics = one_pass.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(dtype).alias("data_type"),
                F.col("rows").alias("n_rows"), F.col(f"nulls_{c}").alias("n_nulls"),
                *[(F.col(f"{name}_{c}") if c in numeric else nothing).alias(f"{name}_value")
                  for name in ("min", "max", "mean")],
            )
            for c, dtype in df.dtypes
        ]))
    )
    counts = _value_counts(df, df.columns)
    distinct = counts.groupBy("column_name").agg(F.count("*").alias("n_distinct"), F.sum("n").alias("n_values"))
    values = F.transform("heads", lambda h: h["value"])
    pairs = F.transform("heads", lambda h: F.concat(h["value"], F.lit("="), h["n"].cast("string")))
    n_distinct = F.coalesce("n_distinct", F.lit(0))
    is_category = (n_distinct <= categories_up_to) & F.col("mean_value").isNull()
    return (
        basics.join(distinct, "column_name", "left").join(_smallest_values(counts, max(examples, categories_up_to)), "column_name", "left")
        .select(
            "column_name", "data_type", "n_rows", "n_nulls", n_distinct.alias("n_distinct"),
            F.array_join(F.slice(values, 1, examples), "|").alias("examples"),
            "min_value", "max_value", "mean_value",
            F.when(is_category, F.array_join(pairs, "|")).alias("categories"),
        )
    )


def cardinalities(named: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """(source, column_name, n_distinct, value, n): how many values a column has and, where asked, each of them.

    `named` gives a frame, the columns to count and the columns to list. A listed column has a row for
    every value, however many there are; the others have one row, without a value.
    """

    def one(name: str, df: DataFrame, counted: Sequence[str], listed: Sequence[str]) -> DataFrame:
        counts = _value_counts(df, [*counted, *listed])
        sizes = counts.groupBy("column_name").agg(F.count("*").alias("n_distinct"))
        members = counts.where(F.col("column_name").isin(*listed))
        return sizes.join(members, "column_name", "left").select(
            F.lit(name).alias("source"), "column_name", "n_distinct", "value", "n"
        )

    return stack_union([one(name, *spec) for name, spec in named.items()])


def fact_shape(named: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(source, n_rows, span_days, n_keys): date span and key cardinality per fact."""
    return stack_union([
        df.agg(
            F.count("*").alias("n_rows"),
            F.datediff(F.max(ts), F.min(ts)).alias("span_days"),
            F.count_distinct(key).alias("n_keys"),
        ).select(F.lit(name).alias("source"), "n_rows", "span_days", "n_keys")
        for name, (df, ts, key) in named.items()
    ])


def children_per_parent(children: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(source, min, mean, max) rows per parent key that has any."""
    return stack_union([
        df.groupBy(fk).agg(F.count("*").alias("n")).agg(
            F.min("n").alias("min_children"), F.avg("n").alias("mean_children"), F.max("n").alias("max_children")
        ).select(F.lit(name).alias("source"), "min_children", "mean_children", "max_children")
        for name, (df, fk) in children.items()
    ])


def max_distinct_per_parent(df: DataFrame, fk: str, col: str) -> DataFrame:
    return df.groupBy(fk).agg(F.count_distinct(col).alias("n")).agg(F.max("n").alias("max_distinct"))


def coverage_gaps(players: DataFrame, children: Mapping[str, DataFrame]) -> DataFrame:
    """(source, players_missing): players without a single row in each child."""
    joined = players.select("player_id")
    for name, df in children.items():
        seen = df.groupBy("player_id").agg(F.lit(True).alias(f"has_{name}"))
        joined = joined.join(seen, "player_id", "left")
    return joined.agg(*[F.count_if(F.col(f"has_{name}").isNull()).alias(name) for name in children]).unpivot(
        [], list(children), "source", "players_missing"
    )


def time_windows(named: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(source, first_day, last_day, span_days): span in complete days."""
    return stack_union([
        df.agg(F.min(ts).cast("timestamp").alias("a"), F.max(ts).cast("timestamp").alias("b")).select(
            F.lit(name).alias("source"), F.to_date("a").alias("first_day"), F.to_date("b").alias("last_day"),
            F.timestamp_diff("DAY", F.col("a"), F.col("b")).alias("span_days"),
        )
        for name, (df, ts) in named.items()
    ])


def totals_by_type(tx: DataFrame) -> DataFrame:
    return tx.groupBy("transaction_type").agg(F.count("*").alias("n"), F.sum("amount").alias("total_amount"))


def money_pivot(tx: DataFrame, kinds: Sequence[str] = ("deposit", "withdraw", "bet")) -> DataFrame:
    """Player x type sums; 0 where a player has none."""
    pivoted = tx.groupBy("player_id").pivot("transaction_type", list(kinds)).agg(F.sum("amount"))
    return pivoted.select("player_id", *[F.coalesce(F.col(k), F.lit(0)).cast(TOTAL).alias(k) for k in kinds])


def impossible_flows(pivot: DataFrame) -> DataFrame:
    deposit, withdraw, bet = F.col("deposit"), F.col("withdraw"), F.col("bet")
    return pivot.agg(
        F.count_if((withdraw > 0) & (deposit == 0)).alias("withdrew_without_deposit"),
        F.count_if((bet > 0) & (deposit == 0)).alias("bet_without_deposit"),
        F.count_if(withdraw > deposit).alias("withdrew_more_than_deposited"),
        F.count_if((deposit > 0) & (bet == 0)).alias("deposited_without_bet"),
    )


def players_per_ip(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("ip").agg(F.count_distinct("player_id").alias("n_players"))


def multi_account_summary(sessions: DataFrame) -> DataFrame:
    """Shared addresses against addresses and devices per player."""
    ips = players_per_ip(sessions).agg(
        F.count("ip").alias("distinct_ips"), F.count_if(F.col("n_players") > 1).alias("shared_ips")
    )
    players = sessions.groupBy("player_id").agg(
        F.count("*").alias("n"), F.count_distinct("ip").alias("ips"), F.count_distinct("device").alias("devices")
    ).agg(
        F.sum("n").alias("n_sessions"),
        F.count_if(F.col("ips") > 1).alias("players_on_many_ips"),
        F.max("ips").alias("max_ips_per_player"),
        F.count_if(F.col("devices") > 1).alias("players_on_many_devices"),
    )
    return one_row(ips, players)


def _depositors(tx: DataFrame) -> DataFrame:
    return tx.where(is_type("deposit")).groupBy("player_id").agg(F.lit(True).alias("deposited"))


def claimed_vs_real_ftd(aff: DataFrame, tx: DataFrame) -> DataFrame:
    """Claims against real deposits, and the figures a naive reading would get wrong."""
    rows = aff.agg(
        F.avg((F.col("ftd") > F.col("registrations")).cast("double")).alias("share_ftd_gt_registrations"),
        F.avg((F.col("registrations") > F.col("clicks")).cast("double")).alias("share_registrations_gt_clicks"),
        F.count_if((F.col("ftd") > 0) & (F.col("registrations") == 0)).alias("claims_without_registrations"),
        F.sum("cpa_value").alias("naive_cpa"),
    )
    per_player = aff.groupBy("player_id").agg(
        F.sum("ftd").alias("claims"), F.count_distinct("affiliate_id").alias("n_affiliates")
    )
    deposited = F.coalesce("deposited", F.lit(False))
    claimed = F.coalesce(F.col("claims") > 0, F.lit(False))
    people = per_player.join(_depositors(tx), "player_id", "full").agg(
        F.count_if(claimed).alias("claimed_players"),
        F.count_if(deposited).alias("real_depositors"),
        F.count_if(claimed & ~deposited).alias("ghost_players"),
        F.count_if(F.col("n_affiliates") > 1).alias("players_with_many_affiliates"),
    )
    return one_row(rows, people)


def attribution_rules(aff: DataFrame, tx: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """(metric, value) comparing three attribution rules.

    R1 first row in ``order_cols``, R2 the claim with the best rank, R3 = R2 gated on a real
    deposit. Each rule is a minimum per player, so the rows are aggregated, never sorted.
    """
    # The claims are a small part of the rows, and only they pay for the distinct count.
    first_rows = aff.groupBy("player_id").agg(F.min(F.struct(*order_cols, "affiliate_id", "cpa_value")).alias("first_row"))
    claims = aff.where("ftd > 0").groupBy("player_id").agg(
        F.min(claim_rank()).alias("best"), F.count_distinct("affiliate_id").alias("claimants")
    )
    per_player = first_rows.join(claims, "player_id", "left")
    joined = per_player.join(_depositors(tx), "player_id", "full").select(
        F.col("first_row").isNotNull().alias("in_file"),
        F.col("first_row.cpa_value").alias("first_cpa"),
        F.col("best").isNotNull().alias("claimed"),
        (-F.col("best.minus_cpa")).cast(MONEY).alias("best_cpa"),
        F.coalesce(F.col("claimants"), F.lit(0)).alias("claimants"),
        F.coalesce("deposited", F.lit(False)).alias("deposited"),
    )
    real = F.col("claimed") & F.col("deposited")
    cards: dict[str, Column] = {
        "r1_players": F.count_if("in_file"),
        "r1_cpa": F.sum("first_cpa"),
        "r2_players": F.count_if("claimed"),
        "r2_cpa": F.sum("best_cpa"),
        "r3_players": F.count_if(real),
        "r3_cpa": F.sum(F.when(real, F.col("best_cpa"))),
        "ghosts_excluded": F.count_if(F.col("claimed") & ~F.col("deposited")),
        "overcount_avoided": F.sum(F.when(F.col("claimed") & ~F.col("deposited"), F.col("best_cpa"))),
        "depositors_without_affiliate": F.count_if(F.col("deposited") & ~F.col("in_file")),
        "tiebreak_decided": F.count_if(F.col("deposited") & (F.col("claimants") > 1)),
    }
    row = joined.agg(*[F.coalesce(c, F.lit(0)).cast(TOTAL).alias(name) for name, c in cards.items()])
    return row.unpivot([], list(cards), "metric", "value")


def join_fanout(left: DataFrame, right: DataFrame, key: str, measure: str) -> DataFrame:
    """Rows and total of ``measure`` before and after a naive left join on ``key``.

    The join itself is never run: matches per key are counted on both sides and multiplied.
    """
    mine = left.groupBy(key).agg(F.count("*").alias("n"), F.sum(measure).alias("total"))
    theirs = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("m"))
    times = F.coalesce("m", F.lit(1))
    return mine.join(theirs, key, "left").agg(
        F.sum("n").alias("rows_before"),
        F.sum("total").alias("sum_before"),
        F.sum(F.col("n") * times).alias("rows_after"),
        F.sum(F.col("total") * times.cast("decimal(18,0)")).alias("sum_after"),
    )


def logical_duplicates(named: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(check_name, n_rows, distinct_rows, duplicate_rows) over each column list."""
    return stack_union([
        df.groupBy(*cols).agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("distinct_rows")
        ).select(
            F.lit(name).alias("check_name"), "n_rows", "distinct_rows",
            (F.col("n_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        )
        for name, (df, cols) in named.items()
    ])


def conflated_grain(aff: DataFrame) -> DataFrame:
    """Evidence that an affiliate row is neither a player's nor an affiliate's record."""
    per_affiliate = aff.groupBy("affiliate_id").agg(F.count("*").alias("n"), F.sum("clicks").alias("clicks")).agg(
        F.min("n").alias("min_rows"), F.percentile("n", F.lit(0.5)).alias("median_rows"), F.max("n").alias("max_rows"),
        F.try_divide(F.sum("clicks").cast("double"), F.sum("n").cast("double")).alias("mean_clicks"),
    )
    many = F.col("n") > 1
    per_player = aff.groupBy("player_id").agg(
        F.count("*").alias("n"), F.min("clicks").alias("low"), F.max("clicks").alias("high")
    ).agg(
        F.count_if(many).alias("players_with_many_rows"),
        F.count_if(many & (F.col("low") != F.col("high"))).alias("players_with_differing_clicks"),
    )
    return one_row(per_affiliate, per_player)


def ts_text_audit(named: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(source, granularity, has_offset, n_rows) read off the raw text of every row."""

    def one(name: str, df: DataFrame, col: str) -> DataFrame:
        text = F.col(col).cast("string")
        grain = (
            F.when(text.rlike(r"\.\d+"), "sub-second").when(text.rlike(r"\d{2}:\d{2}:\d{2}"), "second")
            .otherwise("date-only")
        )
        # An offset needs a clock time before it: the day of '2024-01-15' is none.
        offset = text.rlike(r"Z$|\d{2}:\d{2}.*[+-]\d{2}:?\d{2}$")
        return (
            df.where(text.isNotNull()).groupBy(grain.alias("granularity"), offset.alias("has_offset"))
            .agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("source"), "granularity", "has_offset", "n_rows")
        )

    return stack_union([one(name, *spec) for name, spec in named.items()])


def load_controls(named: Mapping[str, tuple[DataFrame, str | None, str | None]]) -> DataFrame:
    """(source, n_rows, unique_key, watermark, has_updated_at): what supports an incremental load."""

    def one(name: str, df: DataFrame, key: str | None, watermark: str | None) -> DataFrame:
        unique = (F.count("*") == F.count_distinct(key)) if key else F.lit(False)
        kind = f"{watermark}:{dict(df.dtypes)[watermark]}" if watermark else None
        return df.agg(F.count("*").alias("n_rows"), unique.alias("unique_key")).select(
            F.lit(name).alias("source"), "n_rows", "unique_key",
            F.lit(kind).cast("string").alias("watermark"),
            F.lit("updated_at" in df.columns).alias("has_updated_at"),
        )

    return stack_union([one(name, *spec) for name, spec in named.items()])


def volume_baseline(named: Mapping[str, DataFrame]) -> DataFrame:
    return stack_union([
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("source"), "n_rows") for name, df in named.items()
    ])
