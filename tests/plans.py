"""Plan text of a DataFrame, as ``explain`` prints it."""

from __future__ import annotations

import contextlib
import io


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
