"""Print ``explain("formatted")`` of registered queries: ``python tools/show_plans.py [sf_dir] name ...``."""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


def main() -> None:
    from rawfold.plans.registry import QUERIES
    from rawfold.session import build_session
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or ["ShopifyOrders"]
    spark = build_session("local[8]")
    for n in names:
        print(f"==== {n}")
        QUERIES[n](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
