"""Arrow batches cut into pieces, so that a worker holds few whole pages as Python objects."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are taken out of a batch at once.
PIECE_BYTES = 1 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows in their order, in slices with at most ``most`` bytes of the column, or one row. A batch is let go before the next is read."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, taken = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, taken + most, side="right")))
            yield batch.slice(at, to - at)
            at, taken = to, int(ends[to - 1])
        del batch
