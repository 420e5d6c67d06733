"""Shared by the tests of the lakehouse (not a conftest: pytest has one of those per folder)."""

SF_SMALL = "/root/testdata/sf0.001"


def plan_text(df, mode="formatted"):
    """Text of ``df.explain(mode)`` (public API, captured from stdout)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
