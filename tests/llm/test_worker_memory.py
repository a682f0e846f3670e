"""What a Python worker holds while near_dedup makes and compares sets of shingles, and while decontamination reads texts."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from asofmill.llm import decontaminate, simhash
from asofmill.llm.common import ARROW_BYTES, stage


def peak_of(rows):
    """Python's and numpy's most bytes while ``rows`` is read, and what it gave."""
    tracemalloc.start()
    try:
        return list(rows), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_compared_sets_are_not_copied():
    """Before, each batch's sets were copied as a whole: 53 MB here."""
    random = np.random.default_rng(1)
    one = np.unique(random.integers(0, 1 << 63, 10_000, dtype=np.uint64))
    sets = [one.tobytes(), one[:9_000].tobytes(), one[:7_000].tobytes(), b""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(range(400)), pa.array([sets[0]] * 400), pa.array([sets[i % 4] for i in range(400)])], names=["u", "v", "a", "b"])
    (kept,), most = peak_of(simhash._compared(0.8)(iter([batch])))
    assert kept.column(0).to_pylist() == [i for i in range(400) if i % 4 < 2]
    assert most < 4 << 20


def test_sets_are_made_of_small_slices():
    """Before, sets of 2 MB of text were made at once, which took 113 MB."""
    random = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in random.integers(0, 10**6, 300)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], names=["id", "text"])
    counts, most = peak_of((part.num_rows, len(made)) for part, made in simhash._with_sets(iter([batch]), 5))
    assert sum(n for n, _ in counts) == sum(n for _, n in counts) == 2000
    assert most < 20 << 20
    whole = simhash.shingle_sets(batch.column(1), 5)
    assert [x for _, made in simhash._with_sets(iter([batch]), 5) for x in made] == whole


def test_stage_limits_the_bytes_of_a_batch(spark):
    """Before, Spark's 10,000 rows or 64 MB came at once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    before = spark.conf.get(ARROW_BYTES, None)
    rows = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))
    got = stage(rows.mapInArrow(sizes, "n long, bytes long"), "sizes", 1 << 20).collect()
    assert sum(r.n for r in got) == 2000 and max(r.bytes for r in got) < 2 << 20
    assert spark.conf.get(ARROW_BYTES, None) == before


def test_reading_texts_remembers_a_bounded_number_of_tokens():
    """Before, up to 300,000 tokens and the readings of 2 MB of text were held."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([" ".join(f"{1000 * i + j}" for j in range(3000)) for i in range(1, 41)])], names=["id", "text"])
    held = [(part.num_rows, len(both[0].forms), [t.values(int(t.first[0]), 2) for t in both]) for part, both in decontaminate._read(iter([batch] * 20))]
    assert sum(n for n, _, _ in held) == 800
    first = np.cumsum([0, *[n for n, _, _ in held]])[:-1] % 40 + 1
    assert [v for _, _, v in held] == [[[f"{1000 * i}", f"{1000 * i + 1}"]] * 2 for i in first]
    assert max(n for _, n, _ in held) < decontaminate.REMEMBERED + decontaminate.SLICE // 4
    assert max(n for n, _, _ in held) < 40
