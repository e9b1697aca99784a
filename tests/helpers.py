"""What several test modules use."""

from __future__ import annotations

import contextlib
import io


def plan_of(df) -> str:
    """The physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()
