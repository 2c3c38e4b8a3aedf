"""The hourly rollup: one row per account, site, game and source hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import ROLLUP_COLUMNS, SOURCE_KEYS, Settings
from ..functions import clock, text
from ..functions.joins import BROADCAST_ROWS, fact_join, fits, spread_join

PLACED_COLUMNS = ["LinkServerName", "DBName", "TableName", "Type", *ROLLUP_COLUMNS[1:]]
_SUM = "bet_sum"


def measures(bet: Column, payoff: Column) -> list[Column]:
    """Aggregates of one rollup row; the raw bet sum decides whether the row exists."""
    won = F.coalesce(payoff, F.lit(0)) > 0
    return [
        F.sum(bet).alias(_SUM),
        F.count(F.lit(1)).alias("WagersCount"),
        F.coalesce(F.sum(payoff), F.lit(0)).alias("PayOff"),
        F.sum(F.when(won, 1).otherwise(0)).alias("WinsCount"),
    ]


def with_positive_bets(grouped: DataFrame) -> DataFrame:
    """Drop groups whose bets sum to nothing or to NULL, and name the sum."""
    return grouped.filter(F.col(_SUM) > 0).withColumnRenamed(_SUM, "Commissionable")


def _keyed(wagers: DataFrame, settings: Settings) -> DataFrame:
    """Wagers with their grouping keys."""
    return wagers.select(
        *SOURCE_KEYS, clock.hour_floor(F.col("wagerstime")).alias("start_t"),
        text.account_key(F.col("GameAccount"), settings.trim_accounts).alias("GameAccount"),
        "SiteId", "GameTypeSourceId", "betamount", F.col("PayOff").alias("payoff_amount"),
    )


def _grouped(keyed: DataFrame, *more: str) -> DataFrame:
    """One row per source, hour, account, site and game."""
    keys = [*SOURCE_KEYS, "start_t", *more, "GameAccount", "SiteId", "GameTypeSourceId"]
    return with_positive_bets(
        keyed.groupBy(*keys).agg(*measures(F.col("betamount"), F.col("payoff_amount")))
    )


def _same_source(r: str, other: str) -> Column:
    """A row and the source it is read from; ``read_month`` names the month database, if any."""
    same = F.col(f"{r}.MonthDB").eqNullSafe(F.col(f"{other}.read_month"))
    for key in ("LinkServerName", "DBName", "TableName", "Type"):
        same = same & (F.col(f"{r}.{key}") == F.col(f"{other}.{key}"))
    return same


def _window_starts(source_spans: DataFrame) -> DataFrame:
    """Sources with a timezone, and the window starts of the batches they serve."""
    def start(batch: str) -> Column:
        return clock.window_start(F.col(batch), F.col("Timezone"))

    return source_spans.filter(F.col("Timezone").isNotNull()).select(
        "LinkServerName", "DBName", "TableName", "Type", "read_month", "Timezone",
        start("low").alias("from_start"), start("high").alias("to_start"),
    )


def _served(rows: DataFrame, served: DataFrame) -> DataFrame:
    """Rows of hours that their source serves, with its timezone."""
    joined = rows.alias("r").join(served.alias("s"), _same_source("r", "s"))
    in_span = F.col("r.start_t").between(F.col("s.from_start"), F.col("s.to_start"))
    return joined.filter(in_span).select("r.*", "s.Timezone")


_PLACE = ["LinkServerName", "DBName", "TableName", "Type", "month_key"]


def _served_spread(rows: DataFrame, served: DataFrame, wagers: DataFrame) -> DataFrame:
    """Like ``_served`` for more sources than are broadcast; a source with much of the rows is cut."""
    def placed(df: DataFrame, month: str) -> DataFrame:
        return df.filter(" AND ".join(f"{c} IS NOT NULL" for c in _PLACE[:4])).withColumn(
            "month_key", F.coalesce(month, F.lit(""))
        )

    spans = placed(served, "read_month").select(*_PLACE, "Timezone", "from_start", "to_start")
    joined = spread_join(
        placed(rows, "MonthDB"), spans, _PLACE, ["start_t", "GameAccount", "SiteId"],
        counted=placed(wagers.select(*SOURCE_KEYS), "MonthDB"),
    )
    in_span = F.col("start_t").between(F.col("from_start"), F.col("to_start"))
    return joined.filter(in_span).select(*rows.columns, "Timezone")


def in_game_list(
    rows: DataFrame, games: DataFrame, settings: Settings = Settings(), spread: bool = False
) -> DataFrame:
    """Rows of a shared database are kept for listed games only; other databases keep all.

    With ``spread``, games that hold much of the rows are cut.
    """
    keys, listed = ["LinkServerName", "Type", "GameTypeSourceId"], games.withColumn("listed", F.lit(True))
    if spread:
        by = [c for c in ("GameAccount", "SiteId", "start_t") if c in rows.columns]
        shared = rows.filter(F.col("DBName").eqNullSafe(settings.shared_db)).dropna(subset=keys)
        kept = spread_join(shared, listed, keys, by, "left_semi").select(*rows.columns)
        return rows.filter(~F.col("DBName").eqNullSafe(settings.shared_db)).unionByName(kept)
    marked = rows.join(listed, keys, "left")
    keep = ~F.col("DBName").eqNullSafe(settings.shared_db) | F.col("listed")
    return marked.filter(keep).select(*rows.columns)


def hourly_rollup(
    wagers: DataFrame,
    source_spans: DataFrame,
    games: DataFrame,
    settings: Settings = Settings(),
    most: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rollup rows of all batch hours the spans cover, with the source they came from.

    Windows are whole hours, so a row's hour and its source's timezone give its batch: the join
    needs the sources only, not sources times hours. Sources and game lists of at most ``most``
    rows are broadcast and drop wagers before the one wide shuffle. Larger ones wait until the
    wagers are grouped, which their tests allow: all they look at is grouping keys. Then a source or
    game with much of the rows is cut into parts, see ``spread_join``.
    """
    served, rows = _window_starts(source_spans), _keyed(wagers, settings)
    early = fits(served, most)
    early_games = early and fits(games, most)
    if early:
        rows = _served(rows, F.broadcast(served))
    if early_games:
        rows = in_game_list(rows, F.broadcast(games), settings)
    rows = _grouped(rows, "Timezone") if early else _served_spread(_grouped(rows), served, wagers)
    if not early_games:
        rows = in_game_list(rows, games, settings, spread=True)
    batch = clock.plus_hours(F.col("start_t"), 1 - F.col("Timezone"))
    return rows.select(clock.utc_to_output(batch).alias("DatePlayed"), *PLACED_COLUMNS)


def rollup_of_windows(
    wagers: DataFrame,
    manifest: DataFrame,
    games: DataFrame,
    settings: Settings = Settings(),
    most: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rollup rows of listed windows, as a redo has them: matched by source and window start.

    As many windows as may be broadcast drop wagers before the shuffle; more are matched after it.
    """
    windows = manifest.filter(F.col("start_t").isNotNull()).select(
        "LinkServerName", "DBName", "TableName", "Type", "read_month", "start_t", "DatePlayed",
    ).distinct()
    early, rows = fits(windows, most), _keyed(wagers, settings)
    side = F.broadcast(windows) if early else windows.hint("merge")
    joined = (rows if early else _grouped(rows)).alias("r").join(
        side.alias("w"), _same_source("r", "w") & (F.col("r.start_t") == F.col("w.start_t"))
    ).select("r.*", "w.DatePlayed")
    rows = _grouped(joined, "DatePlayed") if early else joined
    return in_game_list(rows, games, settings).select("DatePlayed", *PLACED_COLUMNS)


def without_held(rollup: DataFrame, held: DataFrame) -> DataFrame:
    """Rollup rows of Types that are not held back in their hour."""
    free = fact_join(rollup, held, ["LinkServerName", "Type", "DatePlayed"], "left_anti")
    return free.select(*rollup.columns)


def report_rows(rollup: DataFrame) -> DataFrame:
    """The eight reported columns."""
    return rollup.select(*ROLLUP_COLUMNS)
