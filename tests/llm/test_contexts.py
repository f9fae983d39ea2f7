import random

import numpy as np

from buildlens.llm import langid


def test_a_large_language_takes_no_contexts_from_a_small_one():
    rng = random.Random(3)
    large = [bytes(rng.choices(b"abcdef ", k=400)) for _ in range(60)]
    small = [b"zyx wvu zyx wvut zyxw vut", b"wvu zyx zyxw"]
    probe = b"zyxw vut wvu"

    def bits(most):
        model = langid.Ppm({"large": large, "small": small}, max_contexts=most)
        return model.code_lengths(np.frombuffer(probe, np.uint8), np.array([0, len(probe)]))[model.langs.index("small"), 0]

    assert bits(150) == bits(1_000_000)
