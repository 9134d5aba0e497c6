"""Checks every query of the named catalogue groups: ``python tools/check_group.py scans joins``."""

import os
import sys

here = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(here), here]
import check  # noqa: E402
from dustline.registry import load  # noqa: E402

if __name__ == "__main__":
    groups = sys.argv[1:]
    names = [n for n, q in load().items() if q.build.__module__.split(".")[-1] in groups]
    sys.argv = ["check", *names]
    check.main()
