"""Languages of several scripts, with more letters together than any one has."""

import random

import pyarrow as pa

from fieldpulse.llm import language
from fieldpulse.llm.blocks import blocks
from tests.llm.test_language import phrases


def test_letters_of_the_rarer_scripts_are_told_apart():
    pick = random.Random(3)
    scripts = [("cjk", 0x4E00, 400), ("cyrillic", 0x430, 32), ("greek", 0x3B1, 17), ("latin", 0x61, 26)]
    words = {
        name: ["".join(chr(first + pick.randrange(many)) for _ in range(pick.randint(1, 6))) for _ in range(50)]
        for name, first, many in scripts
    }
    words["slavic"] = [w[::-1] for w in words["cyrillic"]]
    size = {"latin": 4000, "cyrillic": 600, "slavic": 400, "greek": 300, "cjk": 200}
    model = tuple((n, " ".join(pick.choice(words[n]) for _ in range(size[n]))) for n in sorted(words))
    own = language.Parser(model)
    texts = [" ".join(pick.choice(words[name]) for _ in range(40)) for name in sorted(words)]
    (block,) = blocks(pa.array(texts))
    bits, letters = own.estimate(block)
    assert bits.argmin(0).tolist() == list(range(len(words)))
    for i, text in enumerate(texts):
        for j, (_, reference) in enumerate(model):
            assert abs(bits[j, i] - phrases(text, reference) * own.bits[j] / letters[i]) < 1e-9
