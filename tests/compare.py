"""Order-insensitive frame comparison shared by the oracle tests and tools/check.py."""
from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd


def norm(v, digits: int | None = 6):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    if isinstance(v, (list, tuple)):
        return repr(list(v))
    return v


def rows(pdf: pd.DataFrame, digits: int | None = 6):
    cols = sorted(pdf.columns)
    out = [tuple(norm(x, digits) for x in rec) for rec in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=repr)


def same(a: pd.DataFrame, b: pd.DataFrame, digits: int | None = 6) -> tuple[bool, str]:
    ca, ra = rows(a, digits)
    cb, rb = rows(b, digits)
    if ca != cb:
        return False, f"columns {ca} != {cb}"
    if len(ra) != len(rb):
        return False, f"rows {len(ra)} != {len(rb)}"
    if ra != rb:
        diff = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
        return False, f"values differ: {diff}"
    return True, ""
