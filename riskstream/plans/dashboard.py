"""The dashboard's frames, and the snapshot they are computed from."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame

from riskstream.operators import breakdown, locations, ranking, trends
from riskstream.operators.filters import facet_filter, facet_values
from riskstream.operators.measures import summary
from riskstream.operators.sample import monthly_sample
from riskstream.session import stored


class Snapshot:
    """Transactions as of the last load, for all sections of a report.

    ``per_month`` reduces the table to a fixed sample of each month. It is stored, and so
    is a whole table with ``store``, for one that would be read anew, and perhaps changed
    meanwhile, for each section: that of a database. Files are not copied: the
    snapshot's are those listed at the load.
    """

    def __init__(self, load: Callable[[], DataFrame], per_month: int | None = None, *, store: bool = False) -> None:
        self._load = load
        self._per_month = per_month
        self._store = store
        self._frame: DataFrame | None = None
        self.refreshed_at: datetime | None = None

    @property
    def frame(self) -> DataFrame:
        if self._frame is None:
            rows = self._load()
            if self._per_month is not None:
                rows = monthly_sample(rows, self._per_month)
            if self._store or self._per_month is not None:
                rows = stored(rows, "snapshot")
            self._frame = rows
        return self._frame

    def refresh(self) -> DataFrame:
        """Drop the snapshot and read the table again."""
        self.close()
        self.refreshed_at = datetime.now()
        return self.frame

    def close(self) -> None:
        self._frame = None

    def __enter__(self) -> Snapshot:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def dashboard(
    df: DataFrame,
    *,
    status: list[str | None] | None = None,
    location: list[str | None] | None = None,
    card_type: list[str | None] | None = None,
    accuracy: int | None = None,
    by_day: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every frame of the dashboard, over the rows that match the choices.

    The additive sections share one summary by month, so the table is read once for all
    of them; only the daily series groups the rows itself, as a summary by day would be
    about as large as the table. With ``accuracy``, the size of sketches, the summary has some of the amounts, and the boxes are approximate
    ones from it. ``by_day``, a summary by day of the same rows that is there already (that of a merged table, say), takes the place of the
    rows for all additive sections, the daily series included, so that only the listings and exact boxes read rows. The summary by month is persisted; unpersist the frame named ``summary`` when done.
    """
    chosen = facet_filter(df, status=status, location=location, card_type=card_type)
    additive = chosen if by_day is None else facet_filter(by_day, status=status, location=location, card_type=card_type)
    groups = summary(additive, grain="month", sketch=accuracy).persist()
    return {
        "summary": groups,
        "facets": facet_values(df if by_day is None else by_day),
        "kpis": breakdown.kpis(groups),
        "suspicious_split": breakdown.suspicious_split(groups),
        "status_counts": breakdown.status_counts(groups),
        "avg_amount_by_status": breakdown.avg_amount_by_status(groups),
        "card_type_distribution": breakdown.card_type_distribution(groups),
        "monthly_volume": trends.volume(groups),
        "monthly_avg_amount": trends.average_amount(groups),
        "daily_volume": trends.volume(additive, "day"),
        "top_location_histogram": locations.top_location_histogram(groups),
        "location_hotspots": breakdown.location_hotspots(groups),
        "suspicious_by_month": trends.suspicious_by_month(groups),
        "top_location_box": locations.top_location_box(chosen if accuracy is None else groups, counted=groups),
        "suspicious_leaderboard": ranking.suspicious_leaderboard(chosen),
        "latest_suspicious": ranking.latest_suspicious(chosen),
        "recent_transactions": ranking.recent_transactions(chosen),
    }
