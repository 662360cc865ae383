"""What a Python worker holds while it works and after its task, as idle ones stay beside later stages."""

import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from rxlake.llm import jaccard, quality_fm, words

TEXTS = [" ".join(f"w{(i * 37 + j) % 999}" for j in range(400)) for i in range(1000)]  # some 2 MB


def test_the_tokenizer_keeps_to_the_core_of_its_task():
    code = (
        "import os; from rxlake.llm import packing; from rxlake.llm.queries import tokenizer_path\n"
        "tokens = packing.WordTokenizer(tokenizer_path())\n"
        "before = len(os.listdir('/proc/self/task'))\n"
        "tokens._encode_each([f'word{i}' for i in range(3000)])\n"
        "assert len(os.listdir('/proc/self/task')) == before\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=100)


def test_scores_and_sets_work_on_small_parts():
    settings = quality_fm.Settings()
    n = settings.buckets + len(quality_fm.STATISTICS)
    rng = np.random.default_rng(1)
    some = [rng.normal(size=s) for s in (n, (n, 8), 15)]
    model = quality_fm.Model(0.0, some[0], some[1], some[2], np.ones(15))
    column = pa.array(TEXTS)
    tracemalloc.start()
    try:
        scores = quality_fm.score_column(model, column, settings.buckets)
        for _ in jaccard.row_sets(column, 5):
            pass
        assert tracemalloc.get_traced_memory()[1] < 30e6
        words.give_back()
        assert tracemalloc.get_traced_memory()[0] < 6e6
    finally:
        tracemalloc.stop()
    alone = np.concatenate([quality_fm.score_column(model, column.slice(at, 1), settings.buckets) for at in range(0, 1000, 50)])
    assert np.array_equal(scores[::50], alone)
