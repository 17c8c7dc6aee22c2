"""Feature columns to NumPy blocks inside tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd

BLOCK_ROWS = 1024


def is_sparse(df, features: str = "features") -> bool:
    return dict(df.dtypes)[features].startswith("struct")


def block(col, size: int, positions: np.ndarray | None = None, width: int | None = None):
    """A dense block of one Arrow batch.

    ``col`` is a Series of arrays, or a frame with ``indices`` and ``values``.
    ``positions`` maps a feature to its column in the block, -1 to leave it out.
    """
    width = size if width is None else width
    if isinstance(col, pd.DataFrame):
        lengths = col["indices"].map(len).to_numpy()
        out = np.zeros((len(col), width))
        if lengths.sum() == 0:
            return out
        rows = np.repeat(np.arange(len(col)), lengths)
        cols = np.concatenate(col["indices"].to_list()).astype(np.int64)
        vals = np.concatenate(col["values"].to_list()).astype(float)
        if positions is not None:
            cols = positions[cols]
            keep = cols >= 0
            rows, cols, vals = rows[keep], cols[keep], vals[keep]
        np.add.at(out, (rows, cols), vals)
        return out
    if len(col) == 0:
        return np.zeros((0, width))
    full = np.stack(col.to_list()).astype(float)
    if positions is None:
        return full
    used = np.flatnonzero(positions >= 0)
    out = np.zeros((len(full), width))
    out[:, positions[used]] = full[:, used]
    return out


def struct_frame(series: pd.Series) -> pd.DataFrame:
    """A struct column as ``mapInPandas`` delivers it (dicts or rows) to a frame."""
    return pd.DataFrame(
        {
            "indices": [np.asarray(v["indices"]) for v in series],
            "values": [np.asarray(v["values"]) for v in series],
        }
    )


def feature_block(series, size: int, **kw) -> np.ndarray:
    if isinstance(series, pd.DataFrame):
        return block(series, size, **kw)
    if len(series) and isinstance(series.iloc[0], dict):
        return block(struct_frame(series), size, **kw)
    return block(series, size, **kw)


def sparse_blocks(col: pd.DataFrame, width: int, positions: np.ndarray, rows: int):
    """``block`` of every ``rows`` rows of a frame with ``indices`` and ``values``; the lists are joined once for all."""
    lengths = np.fromiter(map(len, col["indices"]), dtype=np.int64, count=len(col))
    if lengths.sum() == 0:
        yield from (np.zeros((len(c), width)) for c in chunks(col, rows))
        return
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(np.arange(len(col)), lengths)
    cols = positions[np.concatenate(col["indices"].to_list()).astype(np.int64)]
    vals = np.concatenate(col["values"].to_list()).astype(float)
    for start in range(0, len(col), rows):
        n = min(rows, len(col) - start)
        part = slice(ends[start], ends[start + n])
        keep = cols[part] >= 0
        cells = (at[part][keep] - start) * width + cols[part][keep]
        yield np.bincount(cells, weights=vals[part][keep], minlength=n * width).reshape(n, width)


def chunks(col, rows: int = BLOCK_ROWS):
    for start in range(0, len(col), rows):
        yield col.iloc[start : start + rows]


def hashed_positions(size: int, dims: int) -> np.ndarray:
    """Fold ``size`` features into ``dims`` columns by a fixed multiplicative hash."""
    if size <= dims:
        return np.arange(size)
    mixed = (np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.uint64(dims)).astype(np.int64)
