"""Model answers that outlive the job that paid for them.

An answer store is a folder of Parquet parts. ``ask`` writes a table of
requests through a Python data source whose writer calls the completion
function itself, inside the write task, and publishes what it has at once: a
part is written under a hidden name and renamed, after ``publish_seconds`` or
``publish_rows``, and at the end of the task. Nothing waits for the job: if it
is lost at any point, the parts of finished tasks and the published ones of
unfinished tasks stay, and are what the next run need not ask again.

Requests go to tasks by ranges of their id (a hash, so the ranges are even
without a sample), and a part's name tells round, task and the first and last
id in it. A task that runs again after a lost executor looks up its own parts
by name and asks only what they don't answer. Each task's commit message
lists its parts; a finished round leaves them in a ``_round-<tag>.json``.
Spark ignores names with a leading dot or underscore, so the folder is read
as an ordinary Parquet table.

The folder must be reachable from every executor through Python: a shared
mount, or a store that pyarrow's file systems know (s3, gs, hdfs).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

ATTEMPT_SCHEMA = (
    "request_id string, rel_path string, chunk_no bigint, attempt bigint, "
    "max_tokens int, response string, error string"
)
_ARROW = pa.schema([("request_id", pa.string()), ("rel_path", pa.string()), ("chunk_no", pa.int64()), ("attempt", pa.int64()),
                    ("max_tokens", pa.int32()), ("response", pa.string()), ("error", pa.string())])

Answer = Callable[[pd.DataFrame], pd.DataFrame]


def python_fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The pyarrow file system of a Spark path, and the path inside it."""
    if "://" not in path or path.startswith("file:"):
        plain = path[len("file:"):] if path.startswith("file:") else path
        return pyarrow.fs.LocalFileSystem(), ("/" + plain.lstrip("/") if plain.startswith("/") else plain)
    if path.startswith("s3a://"):
        path = "s3" + path[3:]
    return pyarrow.fs.FileSystem.from_uri(path)


@dataclass
class Published(WriterCommitMessage):
    """What one task added: its parts, their rows, and the rows it found
    already published by an earlier run of itself."""

    parts: list = field(default_factory=list)
    rows: int = 0
    found: int = 0


class AnswerWriter(DataSourceArrowWriter):
    def __init__(self, path: str, tag: str, answer: Answer, batch_rows: int, publish_rows: int, publish_seconds: float):
        self.path, self.tag, self.answer = path, tag, answer
        self.batch_rows, self.publish_rows, self.publish_seconds = batch_rows, publish_rows, publish_seconds

    def _own_parts(self, fs, folder: str, task: int) -> list[str]:
        start = f"part-{self.tag}-{task:06d}-"
        listed = fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        return [f.path for f in listed if f.base_name.startswith(start)]

    def _publish(self, fs, folder: str, task: int, answered: list[pd.DataFrame]) -> str:
        rows = pd.concat(answered).sort_values("request_id")
        name = f"part-{self.tag}-{task:06d}-{rows.request_id.iloc[0][:8]}-{rows.request_id.iloc[-1][:8]}-{uuid.uuid4().hex[:8]}.parquet"
        hidden = f"{folder}/.{name}"
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(hidden) as out:
            pq.write_table(pa.Table.from_pandas(rows, _ARROW, preserve_index=False), out)
        fs.move(hidden, f"{folder}/{name}")
        return name

    def write(self, iterator):
        context = TaskContext.get()
        task = context.partitionId()
        fs, folder = python_fs(self.path)
        known, done = set(), Published()
        if context.attemptNumber():
            for part in self._own_parts(fs, folder, task):
                with fs.open_input_file(part) as f:
                    known |= set(pq.read_table(f, columns=["request_id"])["request_id"].to_pylist())
                done.parts.append(part.rsplit("/", 1)[1])
        waiting, size, last = [], 0, time.monotonic()
        for batch in iterator:
            asked = batch.to_pandas()
            if known:
                fresh = ~asked["request_id"].isin(known)
                done.found += int((~fresh).sum())
                asked = asked[fresh]
            for i in range(0, len(asked), self.batch_rows):
                rows = self.answer(asked.iloc[i : i + self.batch_rows].reset_index(drop=True))
                waiting.append(rows)
                size += len(rows)
                if size >= self.publish_rows or time.monotonic() - last >= self.publish_seconds:
                    done.parts.append(self._publish(fs, folder, task, waiting))
                    done.rows += size
                    waiting, size, last = [], 0, time.monotonic()
        if waiting:
            done.parts.append(self._publish(fs, folder, task, waiting))
            done.rows += size
        return done

    def commit(self, messages) -> None:
        fs, folder = python_fs(self.path)
        told = [m for m in messages if m is not None]
        body = {"tag": self.tag, "rows": sum(m.rows + m.found for m in told), "parts": [p for m in told for p in m.parts]}
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/_round-{self.tag}.json") as out:
            out.write(json.dumps(body).encode())

    def abort(self, messages) -> None:
        """Published parts are paid for and stay."""


def ask(requests: DataFrame, path: str, answer: Answer, partitions: int | None = None, batch_rows: int = 256,
        publish_rows: int = 20_000, publish_seconds: float = 20.0) -> DataFrame:
    """Answer every request (columns request_id, rel_path, chunk_no, attempt,
    max_tokens and what the function needs) into the store at path, and give
    back this round's answers. ``answer`` gets at most batch_rows requests and
    returns the columns of ATTEMPT_SCHEMA; `partitions` caps how many tasks
    ask at once."""
    spark = requests.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag, columns = uuid.uuid4().hex[:12], requests.schema

    class Answers(DataSource):
        @classmethod
        def name(cls):
            return f"answers_{tag}"

        def schema(self):
            return columns

        def writer(self, schema, overwrite):
            return AnswerWriter(path, tag, answer, batch_rows, publish_rows, publish_seconds)

    spark.dataSource.register(Answers)
    # the first 28 bits of the id: even ranges, one a task
    spot = F.conv(F.substring("request_id", 1, 7), 16, 10).cast("bigint") * n
    ranged = requests.repartitionById(n, F.shiftright(spot, 28).cast("int"))
    ranged.write.format(f"answers_{tag}").mode("append").save()
    return read_round(spark, path, tag)


def read_round(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The answers one call of ``ask`` published."""
    fs, folder = python_fs(path)
    parts = [f for f in fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)) if f.base_name.startswith(f"part-{tag}-")]
    if not parts:
        return spark.createDataFrame([], ATTEMPT_SCHEMA)
    return spark.read.schema(ATTEMPT_SCHEMA).parquet(f"{path}/part-{tag}-*.parquet")


def has_answers(spark: SparkSession, path: str) -> bool:
    """Whether any answer was published to path (by any run)."""
    fs, folder = python_fs(path)
    return any(not f.base_name.startswith((".", "_")) for f in fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)))


def read_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The attempts written so far; empty only when nothing was written yet.
    Any other read error is raised: treating it as "no attempts" would ask
    the model again for every request."""
    if not has_answers(spark, path):
        return spark.createDataFrame([], ATTEMPT_SCHEMA)
    return spark.read.schema(ATTEMPT_SCHEMA).parquet(path)


def answers_to(requests: DataFrame, path: str) -> DataFrame:
    """The attempts at path that answer these requests. The request id is a
    hash of path, chunk number and prompt, so answers to an earlier text or
    prompt of the same chunk are left out."""
    return read_or_empty(requests.sparkSession, path).join(requests.select("request_id"), "request_id", "left_semi")
