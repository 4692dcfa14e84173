"""Print the registered queries as a markdown table (key, what it computes, oracle)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from tessera.plans import catalog
    qs, sql = catalog.queries(), catalog.oracle_sql()
    print("# Registered queries\n")
    print("Generated by `tools/catalog_table.py`. Every key is a callable `f(spark, sf_dir)` in")
    print("`__spark_entry__.queries()`; `oracle` says whether `oracle_sql()` has a DuckDB form.\n")
    print("| key | what it computes | module | oracle |")
    print("| --- | --- | --- | --- |")
    for k in sorted(qs):
        fn = qs[k]
        doc = " ".join((fn.__doc__ or "").strip().split("\n\n")[0].split())
        mod = fn.__module__.rsplit(".", 1)[-1]
        print(f"| `{k}` | {doc.replace('|', '/')} | `{mod}` | {'SQL' if k in sql else 'rows-only'} |")


if __name__ == "__main__":
    main()
