"""What the training-data operators share: Arrow kernels, checkpoints, table access."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import lexspark
from lexspark.checkpoints import checkpointed

cloudpickle.register_pickle_by_value(lexspark)  # kernels travel with their tasks; executors need no copy of this library

__all__ = ["arrow_fields", "checkpointed", "fresh_name", "slices", "struct_kernel", "table"]

#: Bytes of text that a kernel turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_fields(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def slices(array: pa.Array) -> Iterator[pa.Array]:
    """Parts of an array of about SLICE_BYTES each, at least a row."""
    if len(array) == 0:
        return
    rows = max(1, int(SLICE_BYTES * len(array) / max(array.nbytes, 1)))
    for at in range(0, len(array), rows):
        yield array.slice(at, rows)


def struct_kernel(build: Callable[[], Callable[[list], dict]], ddl: str) -> Callable[[Column], Column]:
    """A column function over one column, with a struct of ddl as its result.

    build() runs once in each task and gives a function from a list of values to a dict of columns. The
    function is marked nondeterministic so that the planner runs it once, however often fields are used.
    """
    schema = arrow_fields(ddl)

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kernel = build()
        for array in arrays:
            parts = []
            for part in slices(array):
                out = kernel(part.to_pylist())
                parts.append(pa.StructArray.from_arrays([pa.array(out[f.name], type=f.type) for f in schema], fields=list(schema)))
            yield pa.concat_arrays(parts) if parts else pa.array([], type=pa.struct(list(schema)))

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, StructType.fromDDL(ddl)).asNondeterministic()


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
