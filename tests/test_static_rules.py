"""Static guards: the library stays DataFrame/SQL-only."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "shopmarts"
FORBIDDEN = {
    "localCheckpoint": r"localCheckpoint",
    "cross join": r"crossJoin|how=\"cross\"|, \"cross\"\)",
    "python udf": r"\bF\.udf\b|@udf\b|pandas_udf|\.rdd\.map|mapPartitions\(",
}


def test_library_uses_no_forbidden_constructs():
    for path in LIB.rglob("*.py"):
        text = path.read_text(encoding="utf-8")
        for name, pattern in FORBIDDEN.items():
            assert not re.search(pattern, text), f"{name} in {path.name}"
