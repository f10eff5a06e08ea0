"""Text of a physical plan, for tests on its shape."""

import contextlib
import io


def plan(df, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k.replace("__", "."), None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key.replace("__", "."), value)
        yield
    finally:
        for key, value in old.items():
            name = key.replace("__", ".")
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
