"""Data source writers (SNK-4, SNK-7): tasks write fragments to a folder beside the target, and a commit moves them in.

A path is whatever pyarrow opens by its scheme: files, HDFS, object stores. A fragment counts only if its task's message
reached the driver, so attempts that were lost, and jobs that were aborted, leave nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

ROW_GROUP = 20_000  # rows, so that boxes of row groups along a curve are small


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}" if path.startswith("/") else path)


@dataclass
class Fragment(WriterCommitMessage):
    name: str
    part: int
    rows: int
    size: int


class FolderWriter(DataSourceArrowWriter):
    """Fragments under `_temporary/<job>`, moved on commit; `fill` writes one and gives its rows and bytes."""

    suffix = ""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.options = options["path"].rstrip("/"), overwrite, dict(options)
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = opened(self.path)
        part, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}{self.suffix}"
        store.create_dir(f"{root}/_temporary/{self.job}", recursive=True)
        rows, size = self.fill(store, f"{root}/_temporary/{self.job}/{name}", (b for b in iterator if b.num_rows))
        return Fragment(name, part, rows, size)

    def fill(self, store: fs.FileSystem, file: str, batches: Iterator[pa.RecordBatch]) -> tuple[int, int]:
        raise NotImplementedError

    def commit(self, messages: list) -> None:
        store, root = opened(self.path)
        before = [x.path for x in store.get_file_info(fs.FileSelector(root)) if x.is_file] if self.overwrite else []
        made = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.part)
        self.settle(store, root, made)
        for file in before:  # what stood there when the new files were in place, and no other writer's later ones
            store.delete_file(file)
        self._clear(store, root)

    def settle(self, store: fs.FileSystem, root: str, made: list[Fragment]) -> None:
        for m in made:
            store.move(f"{root}/_temporary/{self.job}/{m.name}", f"{root}/part-{m.part:05d}-{m.name}")

    def abort(self, messages: list) -> None:
        self._clear(*opened(self.path))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/_temporary/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/_temporary/{self.job}")
        if store.get_file_info(f"{root}/_temporary").type != fs.FileType.NotFound and not store.get_file_info(fs.FileSelector(f"{root}/_temporary")):
            store.delete_dir(f"{root}/_temporary")


class GeoParquetWriter(FolderWriter):
    """zstd Parquet with the `geo` key in each footer: version, encoding, the file's own box, and the covering column."""

    suffix = ".parquet"

    def fill(self, store, file, batches):
        rows, held, kept, box = 0, [], 0, [float("inf"), float("inf"), float("-inf"), float("-inf")]
        writer = None

        def flush():
            writer.write_table(pa.Table.from_batches(held), row_group_size=ROW_GROUP)
            held.clear()

        with store.open_output_stream(file) as out:
            for batch in batches:
                writer = writer or pq.ParquetWriter(out, batch.schema, compression="zstd", store_schema=False)  # so that readers take the keys of the footer
                held.append(batch)
                rows, kept = rows + batch.num_rows, kept + batch.num_rows
                places = pa.table({k: batch["bbox"].field(k) for k in ("xmin", "ymin", "xmax", "ymax")}).to_pydict()
                box = [min(box[0], *places["xmin"]), min(box[1], *places["ymin"]), max(box[2], *places["xmax"]), max(box[3], *places["ymax"])]
                if kept >= ROW_GROUP:
                    flush()
                    kept = 0
            if writer:
                if held:
                    flush()
                cover = {"bbox": {k: ["bbox", k] for k in ("xmin", "ymin", "xmax", "ymax")}}
                column = {"encoding": "WKB", "geometry_types": ["Point"], "bbox": box, "covering": cover}
                writer.add_key_value_metadata({"geo": json.dumps({"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": column}})})
                writer.close()
        size = store.get_file_info(file).size
        if not rows:
            store.delete_file(file)
        return rows, size


class LinesWriter(FolderWriter):
    """Text lines as they are, with the option `end` after each and `head` at the top of every file."""

    suffix = ".csv"

    def fill(self, store, file, batches):
        end, rows = self.options["end"], 0
        with store.open_output_stream(file) as out:
            out.write((self.options["head"] + end).encode())
            for batch in batches:
                out.write((end.join(batch.column(0).to_pylist()) + end).encode())
                rows += batch.num_rows
        return rows, store.get_file_info(file).size

    def settle(self, store, root, made):
        if not made:  # a table without rows is its header
            with store.open_output_stream(f"{root}/part-00000-{self.job}{self.suffix}") as out:
                out.write((self.options["head"] + self.options["end"]).encode())
        super().settle(store, root, made)


class FeatureCollectionWriter(FolderWriter):
    """One JSON document as fragments that follow one another by name: a head, a line a feature, commas between fragments, a
    tail. `_manifest.json` says where in the document each of them begins, by prefix sums of their sizes.
    """

    suffix = ".json"
    HEAD, BETWEEN, TAIL = b'{"type":"FeatureCollection","features":[\n', b",\n", b"\n]}\n"

    def fill(self, store, file, batches):
        rows = size = 0
        with store.open_output_stream(file) as out:
            for batch in batches:
                data = ",\n".join(batch.column(0).to_pylist()).encode()
                out.write(self.BETWEEN + data if rows else data)
                size += len(data) + (len(self.BETWEEN) if rows else 0)
                rows += batch.num_rows
        return rows, size

    def settle(self, store, root, made):
        pieces: list[tuple[str | None, bytes, int, int]] = [(None, self.HEAD, len(self.HEAD), 0)]
        for i, m in enumerate(made):
            pieces += [(None, self.BETWEEN, len(self.BETWEEN), 0)] * (i > 0) + [(m.name, b"", m.size, m.rows)]
        pieces.append((None, self.TAIL, len(self.TAIL), 0))
        at, entries = 0, []
        for i, (name, data, size, rows) in enumerate(pieces):
            to = f"part-{i:06d}-{self.job}.json"
            if name:
                store.move(f"{root}/_temporary/{self.job}/{name}", f"{root}/{to}")
            else:
                with store.open_output_stream(f"{root}/{to}") as out:
                    out.write(data)
            entries.append({"file": to, "offset": at, "bytes": size, "features": rows})
            at += size
        with store.open_output_stream(f"{root}/_manifest-{self.job}.json") as out:
            out.write(json.dumps({"bytes": at, "features": sum(e["features"] for e in entries), "parts": entries}).encode())


class GeoParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(self.options, overwrite)


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lines"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options, overwrite)


class FeatureCollection(DataSource):
    @classmethod
    def name(cls) -> str:
        return "featurecollection"

    def writer(self, schema, overwrite: bool) -> FeatureCollectionWriter:
        return FeatureCollectionWriter(self.options, overwrite)
