"""What Python tasks hold at a time, by the arrays and bytes that Python allocates."""

import random
import tracemalloc

import pyarrow as pa

from tidemill.llm import collocations, repeats


def _text(size: int, words: int = 60_000) -> str:
    pick = random.Random(1)
    known = ["".join(pick.choices("etaoinshrdlu", k=pick.randrange(2, 9))) for _ in range(words)]
    text = " ".join(pick.choices(known, k=size // 6))
    return text[:size]


class _Rows:
    """Runs what is given to mapInArrow or applyInArrow at once."""

    def __init__(self, batches):
        self.batches = batches
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        self.value = value
        return self

    def mapInArrow(self, run, schema):
        return run(iter(self.batches))


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_chunks_of_suffixes_are_let_go_one_by_one():
    text = _text(collocations.CHUNK - 100)
    batches = [pa.record_batch({"lang": ["en"], "text": [text]}) for _ in range(3)]

    def work():
        dealt = collocations._deal(_Rows(batches), collocations.np.zeros(0, collocations._U), 3)
        assert sum(b.num_rows for b in dealt) == 9

    _peak(work)  # tables that stay are filled
    assert _peak(work) < 35 * collocations.CHUNK


def test_the_index_of_a_segment_is_lean():
    pick, text = random.Random(2), _text(400_000)
    pool = [text[i:i + 90] for i in range(0, len(text), 90)]
    texts = [" ".join(pick.choices(pool, k=300)).encode() for _ in range(40)]
    bucket = pa.table({"own_id": list(range(40)), "own_text": pa.array(texts, pa.binary()), "bucket": [0] * 40})
    answers = repeats._answer(repeats.HOT)(repeats._ask(1)(bucket))
    windows = repeats._send(1)(bucket, answers)

    _peak(lambda: repeats._index(windows))  # tables that stay are filled
    assert _peak(lambda: repeats._index(windows)) < 95 * windows.nbytes
