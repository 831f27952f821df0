from __future__ import annotations

import shutil

from oracle import SMALL

from starflow.sample_clicks import bronze_view, table


def test_events_of_missing_pages_are_kept(spark, tmp_path):
    """Page ids with gaps: as many bronze rows as events."""
    for name in ("events", "customer", "nation"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    pages = table(spark, SMALL, "pages").filter("page_id % 3 <> 1")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    bronze = bronze_view(spark, str(tmp_path))
    assert bronze.count() == table(spark, SMALL, "events").count()
    assert not bronze.filter("current_url IS NULL").isEmpty()
