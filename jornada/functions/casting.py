"""Text to int with the lenient (non-ANSI) semantics the raw data were written for.

Spark 4 runs with ANSI mode on: ``CAST('1000.7' AS INT)`` raises and
``try_cast`` gives null, while the curated tables were defined against the
lenient cast, which gives 1000. The expression below reproduces the lenient
rules with built-in functions only, independent of ``spark.sql.ansi.enabled``:

* leading/trailing characters up to U+0020 are trimmed;
* an optional sign, ASCII digits, and an optional ``.`` followed by digits;
  the fraction is dropped (truncation toward zero);
* a bare fraction such as ``.5`` or ``-.`` is 0;
* anything else (``1e3``, ``1,000``, ``12a``, empty) and any value outside the
  int range is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters trimmed from both ends (U+0000..U+0020, U+007F), and the
# accepted number shape: sign, digits, optional fraction; or a bare fraction.
_EDGE_CHARS = "".join(chr(i) for i in (*range(0x21), 0x7F))
_NUMBER_SHAPE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)$"


def legacy_int(col: Column | str) -> Column:
    """Lenient text -> int, as the rules above.

    ``try_cast`` only ever sees a sign and digits (it is slow on text it cannot
    parse), so invalid text costs one regex match and nothing more.
    """
    c = F.col(col) if isinstance(col, str) else col
    t = F.trim(c, F.lit(_EDGE_CHARS))
    whole = F.substring_index(t, ".", 1)
    return F.when(
        t.rlike(_NUMBER_SHAPE),
        F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast(T.IntegerType())))


def cast_expr(col: str, data_type: T.DataType) -> Column:
    """Curated type of a raw text column: lenient int, or a plain cast."""
    if isinstance(data_type, T.IntegerType):
        return legacy_int(col)
    return F.col(col).cast(data_type)
