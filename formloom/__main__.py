"""python -m formloom FLOW NAME=PATH...: runs a flow and prints the first rows of what it gives."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from .plans.flows import FLOWS


def main(arguments: list[str]) -> int:
    if not arguments or arguments[0] not in FLOWS:
        print(f"flows: {', '.join(FLOWS)}", file=sys.stderr)
        return 2
    given = dict(a.split("=", 1) for a in arguments[1:])
    if "mappings" in given:
        given["mappings"] = given["mappings"].split(",")
    if "most" in given:
        given["most"] = int(given["most"])
    out = FLOWS[arguments[0]](SparkSession.builder.getOrCreate(), **given)
    for df in out if isinstance(out, tuple) else (out,):
        if isinstance(df, DataFrame):
            df.show(20, truncate=60)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
