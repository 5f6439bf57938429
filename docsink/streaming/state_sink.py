"""A stream of changes kept as state.

Each micro-batch is tagged, its rejects are written, it is turned to actions and added to the state. The checkpoint
commits after that, and a batch that is replayed overwrites what it wrote: the effect is exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import checks, mapping, route
from ..options import Options
from ..plans import job
from ..sources import state

#: Micro-batches after which state that is no longer needed is deleted.
CLEAN_EVERY = 10


def _map_new(fresh: DataFrame, root: str, batch: int, options: Options) -> None:
    """Each resource gets its field mapping once, from the values' schema; not where schemas are ignored, nor for free-form text."""
    kind = fresh.schema["doc"].dataType
    if options.schema_ignore or not isinstance(kind, T.StructType):
        return
    own = fresh.where(~F.col("topic").isin(*options.topic_schema_ignore)) if options.topic_schema_ignore else fresh
    new = mapping.unmapped(route.targets(own), state.mapped(fresh.sparkSession, root, batch))
    mapping.mappings_of(new, kind, options.compact_map_entries).coalesce(1).write.mode("overwrite").parquet(f"{root}/mappings/batch={batch}")


def apply_changes(changes: DataFrame, root: str, batch: int, options: Options) -> None:
    """One micro-batch into the state at `root`: state, rejects, and mappings of new resources."""
    tagged = job.tagged(changes, options).persist()
    try:
        state.write_rejects(checks.rejects(tagged), root, batch)
        checks.stop_if_invalid(tagged, options)
        fresh, malformed = job.split_malformed(job.actions(checks.accepted(tagged), options), options)
        if malformed is not None:
            bad = malformed.select("topic", "partition", "offset", F.col("id").alias("key"), F.col("doc_json").alias("value"), F.lit(checks.MALFORMED).alias("reason"))
            state.write_rejects(bad, root, batch, "write")  # whatever the policy: it says whether the job goes on
            checks.stop_if_malformed(bad, options)
        _map_new(fresh, root, batch, options)
        state.update_state(fresh, root, batch, job.resolver(options))
    finally:
        tagged.unpersist()


def keep_state(changes: DataFrame, root: str, options: Options, checkpoint: str, **trigger) -> StreamingQuery:
    """The running query; trigger as of writeStream.trigger. Without one all that is there is read and the query ends; `linger=True` waits the options' linger between batches."""
    if trigger.pop("linger", False):
        trigger["processingTime"] = f"{options.linger_ms} milliseconds"

    def one(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch, root, batch_id, options)
        if batch_id % CLEAN_EVERY == CLEAN_EVERY - 1:
            state.remove_old(batch.sparkSession, root)

    return changes.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
