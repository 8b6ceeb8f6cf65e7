"""Writes to an index that is kept elsewhere, as requests of bounded size to the user's client.

A client is any object that can be pickled, with `upsert(request, rows)` and `delete(request, ids)`: the name of
the request, and an Arrow table or a list of ids. It must be idempotent by id, as a task that is lost sends its
requests again, under the same names. A client that raises fails its task, and with it the job. The class of a
client travels by name, so its module is installed on the executors or registered with cloudpickle to go by value.

A client may have `finish()`, which is called after the last request of a task: what it held back until then is sent. A
task that sends no request does not call it.
"""

import base64
import uuid

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from pergamon import fixed_values as V
from pergamon.operators.indexing import upsert_batches

#: Ids in one request to delete.
DELETE_IDS = 1_000

#: Groups that ids to delete are dealt to; each ends with at most one request that is not full.
DELETE_PARTS = 64

_FORMAT = "pergamon_requests"
_SHARD, _REQUEST = "_shard", "_request"


def _opened(folder, kind):
    """The file system of a path or URI, and the folder below it for requests of this kind."""
    from pyarrow import fs
    folder = "file:///" + folder[5:].lstrip("/") if folder.startswith("file:") else folder
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{path}/{kind}")
    return system, f"{path}/{kind}"


class FolderClient:
    """Keeps each request as a Parquet file in a folder all executors share; sending one again replaces it.

    `folder` is a path or a URI that Arrow can open.
    """

    def __init__(self, folder):
        self.folder = folder

    def _put(self, kind, request, rows):
        import pyarrow.parquet as pq
        system, path = _opened(self.folder, kind)
        part = f"{path}/_{request}-{uuid.uuid4().hex}"
        pq.write_table(rows, part, filesystem=system)
        system.move(part, f"{path}/{request}.parquet")

    def upsert(self, request, rows):
        self._put("upsert", request, rows)

    def delete(self, request, ids):
        import pyarrow as pa
        self._put("delete", request, pa.table({"id": pa.array(ids, pa.int64())}))


class PackedClient:
    """Keeps the requests of a task in one Parquet file, with their names in a column `request`; for many small ones.

    The file appears when the task is done, under the name of its first request, so a repeated task replaces it. About
    `held` bytes of requests are in memory. `folder` is a path or a URI that Arrow can open.
    """

    def __init__(self, folder, held=16 << 20):
        self.folder, self.held = folder, held
        self._open, self._waiting, self._bytes = {}, {}, {}

    def _put(self, kind, request, rows):
        import pyarrow as pa
        waiting = self._waiting.setdefault(kind, [])
        waiting.append(rows.append_column("request", pa.array([request] * rows.num_rows, pa.string())))
        self._bytes[kind] = self._bytes.get(kind, 0) + rows.nbytes
        if kind not in self._open:
            self._open[kind] = (*self._started(kind, request, waiting[0].schema), request)
        if self._bytes[kind] >= self.held:
            self._written(kind)

    def _started(self, kind, request, schema):
        import pyarrow.parquet as pq
        system, path = _opened(self.folder, kind)
        part = f"{path}/_{request}-{uuid.uuid4().hex}"
        return system, path, part, pq.ParquetWriter(part, schema, filesystem=system)

    def _written(self, kind):
        import pyarrow as pa
        if self._waiting[kind]:
            self._open[kind][3].write_table(pa.concat_tables(self._waiting[kind]).combine_chunks())
        self._waiting[kind], self._bytes[kind] = [], 0

    def upsert(self, request, rows):
        self._put("upsert", request, rows)

    def delete(self, request, ids):
        import pyarrow as pa
        self._put("delete", request, pa.table({"id": pa.array(ids, pa.int64())}))

    def finish(self):
        for kind, (system, folder, part, writer, first) in self._open.items():
            self._written(kind)
            writer.close()
            system.move(part, f"{folder}/{first}.parquet")
        self._open, self._waiting, self._bytes = {}, {}, {}


class _Sent(WriterCommitMessage):
    """What one task has sent."""

    def __init__(self, requests, rows):
        self.requests, self.rows = requests, rows


class RequestWriter(DataSourceArrowWriter):
    """Sends the rows of a task, request by request; holds one request at a time.

    Rows come in order of _shard and _request, and a request ends where these change or where one more row
    would exceed the limit, so only a single row can be larger.
    """

    def __init__(self, options):
        self.client = cloudpickle.loads(base64.b64decode(options["client"]))
        self.run, self.limit, self.kind = options["run"], int(options["limit"]), options["kind"]

    def write(self, iterator):
        sent, rows, open_, key, size, part = 0, 0, [], None, 0, 0

        def send():
            import pyarrow as pa
            name = f"{self.run}-{key[0]}-{key[1]}-{part}"
            table = pa.Table.from_batches(open_)
            if self.kind == "delete":
                self.client.delete(name, table.column("id").to_pylist())
            else:
                self.client.upsert(name, table)

        for batch in iterator:
            keys = list(zip(batch.column(_SHARD).to_pylist(), batch.column(_REQUEST).to_pylist()))
            sizes = batch.column("_size").to_pylist()
            payload = batch.select([c for c in batch.schema.names if c not in (_SHARD, _REQUEST, "_size")])
            first = 0
            for i, (own, bytes_) in enumerate(zip(keys, sizes)):
                other = own != key
                if (other or size + bytes_ > self.limit) and (open_ or i > first):
                    if i > first:
                        open_.append(payload.slice(first, i - first))
                    send()
                    sent, open_, first, size, part = sent + 1, [], i, 0, part + 1
                if other:
                    key, part = own, 0
                size += bytes_
            if len(keys) > first:
                open_.append(payload.slice(first))
            rows += len(keys)
        if open_:
            send()
            sent += 1
        if sent and hasattr(self.client, "finish"):
            self.client.finish()
        return _Sent(sent, rows)


class RequestSink(DataSource):
    """The sink behind `send_upserts` and `send_deletes`. Append only, nothing is read."""

    @classmethod
    def name(cls):
        return _FORMAT

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("requests can only be appended")
        return RequestWriter(self.options)


def _send(spark, rows, client, kind, limit):
    spark.dataSource.register(RequestSink)
    packed = base64.b64encode(cloudpickle.dumps(client)).decode()
    ordered = rows.repartition(_SHARD, _REQUEST).sortWithinPartitions(_SHARD, _REQUEST, "id")
    ordered.write.format(_FORMAT).mode("append").options(
        client=packed, run=uuid.uuid4().hex, kind=kind, limit=limit).save()


def send_upserts(spark, rows, client, limit=V.BATCH_BYTES):
    """Send rows with `id` and `text_chunk` (all their columns) in requests of at most `limit` bytes of text.

    Requests hold neighbours by id. A row larger than the limit is a request of its own; null texts have no
    bytes; repeated ids are all sent, in no order. No rows, no request. `rows` is read twice, so it should be stored.
    """
    numbers = upsert_batches(rows.select("id", "text_chunk"), limit).groupBy("id").agg(
        F.min("shard").alias(_SHARD), F.min("batch").alias(_REQUEST))
    size = F.coalesce(F.octet_length("text_chunk"), F.lit(0)).cast("long")
    _send(spark, rows.withColumn("_size", size).join(numbers, "id"), client, "upsert", limit)


def send_deletes(spark, ids, client, limit=DELETE_IDS):
    """Send the distinct ids (column `id`) in requests of at most `limit`; null is no id.

    Ids are dealt by their hashes, not by their ranges: a document's ids lie far from the next one's.
    """
    ids = ids.where("id IS NOT NULL").select(F.col("id").cast("long").alias("id")).distinct()
    shard = F.pmod(F.xxhash64("id"), F.lit(DELETE_PARTS)).cast("long")
    _send(spark, ids.select("id", shard.alias(_SHARD), F.lit(0).cast("long").alias(_REQUEST),
                            F.lit(1).cast("long").alias("_size")), client, "delete", limit)
