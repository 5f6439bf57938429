"""A stream of changes sent to a target.

Rejects of the checks and of the target's answers, and the offsets that are done, are published with each micro-batch by the
sink's two-phase commit (sources.bulk): bulk.read_rejects and bulk.read_done give them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import checks
from ..options import Options
from ..plans import job
from ..sources import bulk


def send_changes(changes: DataFrame, url: str, root: str, options: Options, checkpoint: str, **trigger) -> StreamingQuery:
    """The running query; trigger as of writeStream.trigger. Without one all that is there is read and the query ends.

    Rows with a reason are not sent. One whose reason must stop the job makes the query fail, as a fatal answer does.
    """
    tagged = job.tagged(changes, options).withColumn("stops", checks.fatal(options))
    rows = bulk.bulk_rows(job.actions(tagged, options), options.max_in_flight)
    bulk.register(changes.sparkSession)
    settings = bulk.sink_options(options, url, outcomes=root)
    return rows.writeStream.format("docsink_bulk").options(**settings).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
