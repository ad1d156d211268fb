import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session, ensure_checkpoint_dir
    s = build_session(master="local[4]", shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty, blank, wordless, tied, repeated, long and mixed-script texts."""
    rnd = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "Ünïcode", "42", "x9", "the", "of"]
    long = " ".join(rnd.choice(words) + str(rnd.randint(0, 999)) for _ in range(30_000))
    return [None, "", " ", "\n\n", "\t \n", "...", "a", "a a a a a a a a", "one two three four five",
            "one two three four five", "ONE two three four five", long, "日本語 テキスト 😀", "é" * 500, "x" * 3000,
            "line one\nline one\nline two", "<|endoftext|> a<|endoftext|>b", "Released under the MIT License.", "0 1 2 3 4 5 6 7 8 9"]
