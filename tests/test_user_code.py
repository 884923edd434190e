"""User code in tasks: what it takes of memory does not grow with the rows."""

import gc
import weakref

import pandas as pd

from aerolake.plans import catalog


def test_columns_are_free_once_they_are_read():
    """Without the garbage collector: nothing of the batches before the last one is left."""
    seen, sizes = [], []

    def frames():
        for n in range(5):
            frame = pd.DataFrame({"recordId": [str(n), "x"], "data": ["%%%", "a" * n]})
            seen.append(weakref.ref(frame["data"]))
            yield frame

    gc.disable()
    try:
        for frame in catalog._lengths()(frames()):
            sizes += frame["size"].tolist()
        assert [ref() is None for ref in seen[:-1]] == [True] * 4
    finally:
        gc.enable()
    assert sizes == [3, 0, 3, 1, 3, 2, 3, 3, 3, 4]
