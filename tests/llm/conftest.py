import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

# Columns whose names the operators use themselves.
EXTRA = "row_key long, node string, bucket int, salt int, key long, shard int, score double"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edge_rows():
    """Awkward documents: (doc_id, text)."""
    rng = random.Random(5)
    base = words(rng, 120)
    long_ = " ".join(words(rng, 60_000, 50_000))
    near = list(base)
    near[60] = "changed"
    passage = words(rng, 40)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "two words"), (6, "Three small words"),
        (10, " ".join(base)), (11, " ".join(base)), (12, " ".join(near)), (13, " ".join(base)),
        (14, "\n".join(base)), (15, " ".join(base[:80])), (16, " ".join(base).upper()),
        (20, long_), (21, long_), (22, long_[:50_000] + " tail"),
        (30, "spam " * 700), (31, "spam " * 300), (32, "a b c a b c a b c"),
        (40, "line one here\nline one here\nline two\n\nline one here"),
        (50, "é ü ñandú ÀÉ Straße MIT License; the Apache LICENSE, version 2.0 and a mit  license"),
        (51, "Licensed under the GNU General Public License, version 3. general public license"),
        (52, "### *** $$$ %%% &&& ||| <>" * 5),
        (53, "zero\x00byte \x0b vertical \x0c feed \x1c mark \u2003 space \U0001f600 face"),
    ]
    for i in range(60, 90):
        mine = words(rng, 60)
        at = rng.randrange(60)
        rows.append((i, " ".join(mine[:at] + passage + mine[at:])))
    return rows


def frame(spark, rows, schema="doc_id long, text string", partitions=5):
    names = schema + ", lang string, source string, n_chars long, " + EXTRA
    full = [(*r, "en", "s0" if n % 3 else None, None if r[1] is None else len(r[1]),
             n, "x", 1, 2, 3, 4, 0.5) for n, r in enumerate(rows)]
    return spark.createDataFrame(full, names).repartition(partitions)


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, edge_rows()).cache()


@pytest.fixture(scope="session")
def empty(spark, edge):
    return edge.limit(0).cache()
