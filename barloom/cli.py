"""``python -m barloom.cli list``, ``python -m barloom.cli run QUERY SF_DIR [OUT]`` or ``python -m barloom.cli check [SF_DIR]``."""

from __future__ import annotations

import importlib.util
import sys

#: What the engine imports.
REQUIRED = ["pyspark", "pyarrow", "numpy", "pandas"]


def health(sf_dir: str | None = None) -> list[str]:
    """What is wrong with this installation, empty if nothing: packages, a session with a Python worker, the tables of ``sf_dir``."""
    missing = [p for p in REQUIRED if importlib.util.find_spec(p) is None]
    if missing:
        return [f"missing packages: {', '.join(missing)}"]
    from pyspark.sql import SparkSession

    from barloom.session import build_session
    from barloom.sources import tables

    wrong = []
    spark = SparkSession.getActiveSession() or build_session("local[*]")
    try:
        found = spark.range(3).mapInArrow(lambda batches: batches, "id long").count()
        if found != 3:
            wrong.append(f"a Python worker returned {found} of 3 rows")
    except Exception as e:
        wrong.append(f"no job runs: {str(e).splitlines()[0]}")
    for name in ("events", "lineitem") if sf_dir else ():
        try:
            if tables.table(spark, sf_dir, name).isEmpty():
                wrong.append(f"table {name} is empty")
        except Exception as e:
            wrong.append(f"table {name} cannot be read: {str(e).splitlines()[0]}")
    return wrong


def main(args: list[str]) -> int:
    if args[:1] == ["check"]:
        wrong = health(args[1] if len(args) > 1 else None)
        print("\n".join(wrong) or "OK")
        return 1 if wrong else 0
    from barloom.plans import catalog

    found = catalog.queries()
    if args[:1] == ["list"]:
        print("\n".join(sorted(found)))
        return 0
    if args[:1] != ["run"] or len(args) < 3 or args[1] not in found:
        print(__doc__)
        return 2
    from barloom.session import build_session

    out = found[args[1]](build_session("local[*]"), args[2])
    if len(args) > 3:
        out.write.mode("overwrite").parquet(args[3])
    else:
        out.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
