"""Columns computed from a text column, batch by batch inside Spark's tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Text handed to one call of the computing function; a single longer text is handed over alone.
CHUNK_BYTES = 2 << 20

Work = Callable[..., Sequence]


def named(column: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame without columns of these names, upper and lower case being the same."""
    gone = {n.lower() for n in names}
    return df.select(*[named(c) for c in df.columns if c.lower() not in gone])


def hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with names that no operator adds, and the hidden name of each column."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def shown(frame: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``hidden`` under their own names, and no others."""
    return frame.select(*[F.col(inner).alias(outer) for outer, inner in names.items()])


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``CHUNK_BYTES`` of the text column each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > CHUNK_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def append(docs: DataFrame, text: str, added: str, make: Callable[[], Work],
           keep: Sequence[str] | None = None, also: Sequence[str] = ()) -> DataFrame:
    """The rows of ``docs`` with columns computed from ``text``.

    ``make()`` runs once in a task and returns a function from a list of texts (None for null), and a list for each
    column named in ``also``, to one list of values, or Arrow array, per added column. ``added`` declares these as DDL. ``keep`` names
    the columns of ``docs`` to return, all if not given; those that clash with an added one are left out.
    """
    new = T.StructType.fromDDL(added)
    names = {f.name.lower() for f in new}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    given = [text, *also]
    extra = [c for c in given if c not in kept]
    # plain names inside, since a name with a dot can't be handed over
    source = docs.select(*[named(c).alias(f"_p{i}") for i, c in enumerate([*kept, *extra])])
    places = [kept.index(c) if c in kept else len(kept) + extra.index(c) for c in given]
    at = places[0]
    out = T.StructType(source.schema.fields[:len(kept)] + list(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        types = [to_arrow_type(f.dataType) for f in new]
        for whole in batches:
            for batch in chunks(whole, at):
                work = work or make()
                values = work(*[batch.column(i).to_pylist() for i in places])
                arrays = batch.columns[:len(kept)]
                arrays += [v if isinstance(v, pa.Array) else pa.array(v, type=t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return source.mapInArrow(run, out).toDF(*kept, *new.names)
