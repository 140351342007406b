"""SN0-SN3 as a stream: one state per key, deletes closed by a timer.

Extracts arrive as rows ``(key, payload..., run_ts)``, one micro-batch or more a
run.  The state of a key is its open version and the run that last held it.  A row
whose check columns differ closes the open version at its run and opens a new
one.  The watermark follows the runs without delay, and each row sets its
key's timer just behind its run: when the next run's time becomes the watermark,
keys that it didn't hold time out and their versions are closed at that time.
Closed keys leave the state, so it holds the open versions and nothing else.

The stream emits a version when it opens (``dbt_valid_to`` NULL) and again when it
closes; ``latest_versions`` folds what was emitted into the history table.

Runs must arrive in order, each whole before the next; rows of one key and run are
reduced to the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..operators.scd2 import SCD_COLUMNS, scd_id

_EXACT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def version_events(extracts: DataFrame, key: str, payload: tuple, check: tuple) -> DataFrame:
    """Opened and closed versions of a stream of extracts with a ``run_ts`` column."""
    schema = StructType([extracts.schema[c] for c in payload])
    rows = extracts.select(
        F.col(key).cast("string").alias("k"), F.to_json(F.struct(*payload), _EXACT).alias("payload"),
        F.md5(F.to_json(F.struct(*check), _EXACT)).alias("digest"), F.col("run_ts").cast("timestamp").alias("run_ts"))

    def versions(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        if state.hasTimedOut:
            text, _, opened, _ = state.get
            out.append((k[0], text, opened, state.getCurrentWatermarkMs()))
            state.remove()
        else:
            rows = pd.concat(list(batches)).drop_duplicates("run_ts").sort_values("run_ts")
            held = state.get if state.exists else None
            for row in rows.itertuples():
                run = row.run_ts.value // 1_000_000
                if held and run <= held[3]:
                    continue                                     # a run that was seen already
                if held and held[1] != row.digest:
                    out.append((k[0], held[0], held[2], run))
                    held = None
                if held is None:
                    held = (row.payload, row.digest, run, run)
                    out.append((k[0], row.payload, run, None))
                held = (*held[:3], run)
            state.update(held)
            state.setTimeoutTimestamp(max(held[3], state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"k": [o[0] for o in out], "payload": [o[1] for o in out], "opened": pd.array([o[2] for o in out], dtype="Int64"),
                            "closed": pd.array([o[3] for o in out], dtype="Int64")})

    found = rows.withWatermark("run_ts", "0 seconds").groupBy("k").applyInPandasWithState(
        versions, "k string, payload string, opened long, closed long", "payload string, digest string, opened long, seen long",
        "append", GroupStateTimeout.EventTimeTimeout)
    at = lambda c: F.timestamp_millis(c).cast("timestamp_ntz")
    found = found.select("k", F.from_json("payload", schema, _EXACT).alias("p"), at(F.col("opened")).alias("opened"), at(F.col("closed")).alias("closed"))
    return found.select("p.*", scd_id(F.col("k"), F.col("opened")).alias("dbt_scd_id"), F.col("opened").alias("dbt_updated_at"),
                        F.col("opened").alias("dbt_valid_from"), F.col("closed").alias("dbt_valid_to"))


def latest_versions(events: DataFrame) -> DataFrame:
    """The history table: each version once, closed if it was closed."""
    payload = [c for c in events.columns if c not in SCD_COLUMNS]
    found = events.groupBy("dbt_scd_id").agg(F.max(F.struct(F.col("dbt_valid_to").isNotNull(), "dbt_valid_to", "dbt_updated_at", "dbt_valid_from", *payload)).alias("v"))
    return found.select(*[f"v.{c}" for c in payload], "dbt_scd_id", "v.dbt_updated_at", "v.dbt_valid_from", "v.dbt_valid_to")
