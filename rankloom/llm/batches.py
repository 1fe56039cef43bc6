"""Arrow batches in small pieces, so that a worker holds few texts as Python objects."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

# Rows and UTF-8 bytes of a piece; a longer text is a piece of its own.
PIECE_ROWS = 512
PIECE_BYTES = 1 << 20


def pieces(batches: Iterable[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, bounded by rows and by the bytes of column ``text_at``."""
    for batch in batches:
        at, n = 0, batch.num_rows
        while at < n:
            rows = min(PIECE_ROWS, n - at)
            while rows > 1 and batch.column(text_at).slice(at, rows).nbytes > PIECE_BYTES:
                rows = max(1, rows // 2)
            yield batch.slice(at, rows)
            at += rows
