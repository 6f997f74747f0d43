"""How tests look at physical plans."""

import contextlib
import io


def physical_plan(df):
    """The text ``explain`` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
