"""Token swaps: readable amounts and distinct traders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.functions.convert import scaled_units

# --- fixed values: raw amount column -> decimals of its token ----------------
PAIR_DECIMALS = {"amount0_in": 6, "amount1_in": 18, "amount0_out": 6, "amount1_out": 18}


def swap_amounts(swaps: DataFrame, decimals: dict[str, int | Column] | None = None) -> DataFrame:
    """Raw integer amounts (text or numeric) as whole tokens; row-local."""
    decimals = PAIR_DECIMALS if decimals is None else decimals
    return swaps.withColumns({c: scaled_units(F.col(c).cast("string"), d) for c, d in decimals.items()})


def unique_takers(swaps: DataFrame, taker: str = "taker", sender: str = "tx_from", by: tuple[str, ...] = (),
                  approximate: bool = False) -> DataFrame:
    """Distinct direct takers and distinct transaction senders.

    Exact counts deduplicate before the shuffle; ``approximate`` replaces them
    with sketches of fixed size.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return swaps.groupBy(*by).agg(count(taker).alias("unique_takers_direct"), count(sender).alias("unique_users_tx_from"))
