"""Blocks of a table as files in the shared folder, which tasks read one at a time."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retain.llm.common import shared_path

_held: dict[str, pa.Table] = {}


def put_blocks(rows: DataFrame, n_blocks: int, key: str, label: str) -> list[str]:
    """Deal `rows` to files by a hash of the unique column `key`; the driver gets their names."""
    folder = shared_path(rows.sparkSession, label).rstrip("/")

    def put(block: pa.Table) -> pa.Table:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.arrow"
        with store.open_output_stream(f"{root}/{name}", compression=None) as out, pa.ipc.new_file(out, block.schema) as file:
            file.write_table(block)
        return pa.table({"file": [f"{folder}/{name}"]})

    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(max(1, n_blocks))))
    return sorted(r["file"] for r in dealt.groupBy("_block").applyInArrow(put, "file string").collect())


def get_block(file: str) -> pa.Table:
    """A block's rows; a worker holds those of one file at a time."""
    if file not in _held:
        _held.clear()
        store, path = fs.FileSystem.from_uri(file)
        with store.open_input_file(path) as source:
            _held[file] = pa.ipc.open_file(source).read_all()
    return _held[file]
