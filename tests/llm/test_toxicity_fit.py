"""The fit of the toxicity model keeps little per sentence and word of its texts."""

import random
import tracemalloc

import numpy as np

from shopscope.llm import toxicity


def test_fit_holds_few_bytes_per_word(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 3)
    monkeypatch.setattr(toxicity, "FIT_CHUNK", 1 << 12, raising=False)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [". ".join(" ".join(rnd.choices(words, k=4)) for _ in range(200)) for _ in range(200)]
    labels = np.array([int("w7 " in t and i % 3 == 0) for i, t in enumerate(texts)])
    tracemalloc.start()
    try:
        model = toxicity.fit(texts, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert toxicity.BIAS in model
    # 160,000 words in 40,000 sentences; before, 47 bytes a word.
    assert peak < 34 * 160_000
