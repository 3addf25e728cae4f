"""Load landed runs into the base table as their manifests arrive.

A run's manifest is written last, so the stream reads manifests and each micro-batch
is one whole run: how a run is cut into pages cannot change what is stored. The
stream's checkpoint remembers which runs were taken. A run may be delivered twice
after a failure; the merge then finds nothing to do.
"""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone import schemas
from siltstone import values as V
from siltstone.plans.lake import Lake
from siltstone.plans.layers import LoadReport, load_base

MANIFESTS = "*/manifest*"


def load_new_runs(
    lake: Lake,
    landing_root: str,
    checkpoint: str,
    *,
    dataset_id: str,
    json_lines: bool = False,
    on_load: Callable[[LoadReport], None] | None = None,
    on_refusal: Callable[[Row], None] | None = None,
) -> StreamingQuery:
    """Start loading every run under the landing root not loaded before, then stop.

    A run passes the gates of its load mode: a full snapshot replaces the table, any
    other run is merged. A run whose manifest is not a success is not loaded.
    """
    manifests = (
        lake.spark.readStream.schema(schemas.MANIFEST)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", 1)
        .json(f"{landing_root.rstrip('/')}/{MANIFESTS}")
        .select("run_id", "status", "load_mode", F.col("_metadata.file_path"))
    )

    def load(batch: DataFrame, number: int) -> None:
        for manifest in batch.collect():  # one manifest
            prefix = manifest["file_path"].rpartition("/manifest")[0]
            if manifest["status"] != V.SUCCESS:
                if on_refusal is not None:
                    on_refusal(manifest)
                continue
            report = load_base(
                lake,
                f"{prefix}/",
                run_id=manifest["run_id"] or prefix.rpartition("/")[2],
                dataset_id=dataset_id,
                full_snapshot=manifest["load_mode"] == V.FULL_SNAPSHOT,
                json_lines=json_lines,
                ingested_at=datetime.now(timezone.utc),
            )
            if on_load is not None:
                on_load(report)

    return (
        manifests.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
