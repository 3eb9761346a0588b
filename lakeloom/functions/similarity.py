"""String and vector similarity: Arrow UDFs where Spark has no built-in."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised for a common prefix of up to four characters where it is over 0.7."""
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(max(n, m) // 2 - 1, 0)
    used = bytearray(m)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = 1
                left.append(c)
                break
    if not left:
        return 0.0
    right = [b[j] for j in range(m) if used[j]]
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    hits = len(left)
    jaro = (hits / n + hits / m + (hits - swaps) / hits) / 3
    if jaro <= 0.7:
        return jaro
    prefix = next((i for i in range(min(4, n, m)) if a[i] != b[i]), min(4, n, m))
    return jaro + prefix * 0.1 * (1 - jaro)


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by bit-parallel rows."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def token_sort_ratio(a: str, b: str) -> float:
    """Indel similarity of the sorted tokens: twice the common subsequence over both lengths."""
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 1.0 if not x and not y else 2 * lcs_length(x, y) / (len(x) + len(y))


@F.pandas_udf(StructType([StructField(c, DoubleType()) for c in ("jw", "ts", "combined")]))
def score_pair(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    rows = []
    for x, y in zip(a, b, strict=True):
        jw, ts = jaro_winkler(x or "", y or ""), token_sort_ratio(x or "", y or "")
        rows.append((round(jw, 4), round(ts, 4), round(max(jw, ts), 4)))
    return pd.DataFrame(rows, columns=["jw", "ts", "combined"])


def dot(a: Column, b: Column) -> Column:
    """Dot product in double; of unit vectors their cosine."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
