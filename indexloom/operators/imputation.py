"""Forward filling of prices and quantities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import cols, month_index


def forward_fill(df: DataFrame, limit: int, group_cols: Sequence[str], units: Sequence[str] = (), stretch: str | None = None) -> DataFrame:
    """``df`` and, after each observation, up to ``limit`` further observed months without one, with its values; imputed 0 or 1.

    Months are those that the whole table has, so gaps in the calendar don't count. Nothing is filled before a product
    is first seen. Each row is spread over the gap behind it, so the grid of products and months is never made.

    ``units`` are columns, the same for all of a product's rows, by which these may be dealt out already; they go.

    With ``stretch``, rows are dealt out by group and stretch of 4 * limit months, whose number is in the column of that name.
    Each row is sent to the one or two stretches that it is spread over, and spread there: for what comes next by group and
    month, a fourth more rows are shuffled than were observed, instead of all filled ones.
    """
    keys = [*group_cols, "product_id"]
    seen = df.where("price IS NOT NULL")
    # One plan for all three uses: Spark runs equal ones once.
    months = month_index(seen)
    last = months.agg(F.max("t")).scalar()
    following = F.lead("t").over(Window.partitionBy(*units, *keys).orderBy("t"))
    until = F.greatest("t", F.least(F.coalesce(following - 1, last), F.col("t") + limit))
    spread = seen.join(F.broadcast(months), "month").withColumn("until", until).select(*keys, "price", "quantity", F.col("t").alias("from"), "until")
    begin, end = F.col("from"), F.col("until")
    if stretch:
        width = 4 * limit
        part = F.explode(F.sequence(F.floor(begin / width), F.floor(end / width)).cast("array<int>"))
        spread = spread.withColumn(stretch, part).repartition(*cols(group_cols), F.col(stretch))
        begin, end = F.greatest(begin, F.col(stretch) * width), F.least(end, F.col(stretch) * width + width - 1)
    filled = spread.withColumn("t", F.explode(F.sequence(begin, end))).join(F.broadcast(months), "t")
    more = [stretch] if stretch else []
    return filled.select(*cols(keys), "month", "price", "quantity", (F.col("t") > F.col("from")).cast("int").alias("imputed"), *more)


def impute(df: DataFrame, group_cols: Sequence[str], active: bool, limit: int, units: Sequence[str] = (), stretch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with flags, rows without). The second are dealt out by ``stretch`` if that is given and something is filled."""
    if not active:
        df = df.drop(*units)
        return df.withColumn("imputed", F.lit(0)), df
    flagged = forward_fill(df, limit, group_cols, units)
    return flagged, (forward_fill(df, limit, group_cols, units, stretch) if stretch else flagged).drop("imputed")
