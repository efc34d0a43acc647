"""The frames behind each widget of the dashboard."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lienspark.operators.summary import (
    heatmap,
    kpis,
    kpis_of,
    purpose_breakdown,
    risk_hierarchy,
    state_names,
    years,
)


def selected(rows: DataFrame, year: int, states: Sequence[str]) -> DataFrame:
    """Rows of one year and the named states; no states, no rows."""
    return rows.where((F.col("data_year") == year) & F.col("state_name").isin(list(states)))


def filter_choices(summary: DataFrame) -> dict[str, DataFrame]:
    """What the two filters offer."""
    return {"years": years(summary), "state_names": state_names(summary)}


def dashboard_frames(
    summary: DataFrame, sample: DataFrame, year: int, states: Sequence[str]
) -> dict[str, DataFrame]:
    """Every frame of one selection. Only the heatmap shows all states."""
    chosen = selected(summary, year, states)
    return {
        "kpis": kpis(chosen),
        "risk_hierarchy": risk_hierarchy(chosen),
        "heatmap": heatmap(summary, year),
        "income_vs_spread": selected(sample, year, states),
        "purpose_breakdown": purpose_breakdown(chosen),
    }


# Grouping ids of (state, segment, purpose), of which those left out count 4, 2 and 1.
_FRAMES = {3: "state", 4: "purpose", 5: "segment", 7: "selection"}


def dashboard_rows(summary: DataFrame, year: int, states: Sequence[str]) -> DataFrame:
    """What the summary says of one selection, grouped four ways in one pass.

    ``frame`` tells the rows apart: every ``state`` of the year, and of the selection
    each ``purpose`` of a segment, each ``segment``, and all. ``frames_from`` makes
    the widgets' frames of them.
    """
    chosen = F.coalesce(F.col("state_name").isin(list(states)), F.lit(False))
    rows = summary.where(F.col("data_year") == year).withColumn("chosen", chosen)
    keys = [F.col(name) for name in ("state_code", "risk_segment", "loan_purpose_name")]
    sets = [keys[:1], keys[1:], keys[1:2], []]

    def of_chosen(name: str) -> Column:
        return F.sum(F.when(F.col("chosen"), F.col(name))).alias(name)

    grouped = rows.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("sets"),
        F.sum("loan_count").alias("all_loans"),
        *map(of_chosen, ("loan_count", "total_loan_amount", "sum_interest_rate")),
        F.sum(F.when(F.col("chosen") & (F.col("risk_segment") == "High"), F.col("loan_count"))).alias("high_risk_count"),
    )
    names = F.create_map(*(F.lit(v) for pair in _FRAMES.items() for v in pair))
    named = grouped.withColumn("frame", F.element_at(names, F.col("sets").cast("int")))
    of_state = F.col("frame") == "state"
    shown = named.where(of_state | F.col("loan_count").isNotNull())
    chosen_only = (F.when(~of_state, F.col(n)).alias(n) for n in ("total_loan_amount", "sum_interest_rate", "high_risk_count"))
    loans = F.when(of_state, F.col("all_loans")).otherwise(F.col("loan_count")).alias("loan_count")
    return shown.select("frame", *keys, loans, *chosen_only)


def frames_from(rows: DataFrame) -> dict[str, DataFrame]:
    """The widgets' frames of ``dashboard_rows``, best read from where these are stored."""

    def of(frame: str) -> DataFrame:
        return rows.where(F.col("frame") == frame)

    pairs = of("purpose").select("risk_segment", "loan_purpose_name", "loan_count")
    totals = of("segment").select("risk_segment", "loan_purpose_name", "loan_count")
    return {
        "kpis": kpis_of(of("selection"), F.sum("high_risk_count")),
        "risk_hierarchy": pairs.withColumn("is_total", F.lit(0)).unionAll(
            totals.withColumn("is_total", F.lit(1))
        ),
        "heatmap": of("state").select("state_code", "loan_count"),
        "purpose_breakdown": pairs.where(F.col("loan_purpose_name").isNotNull()).select(
            "loan_purpose_name", "risk_segment", "loan_count"
        ),
    }


@contextmanager
def kept(summary: DataFrame) -> Iterator[DataFrame]:
    """Keep a summary over several selections, and let go of it afterwards."""
    summary = summary.persist()
    try:
        yield summary
    finally:
        summary.unpersist()
