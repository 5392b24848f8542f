"""What a Python worker keeps between tasks, in a pipeline whose workers go from stage to stage."""

import subprocess
import sys

import public_tokenizers

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_what_packing_leaves_in_a_worker():
    work = f"""
import random, re
from anchorage.llm import packing
def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())))
rng, ends = random.Random(1), ["ation", "ment", "the", "ou", "er", "ing", "ñ", "日", "ha", "st"]
words = lambda n: " ".join("".join(rng.choices(ends, k=6)) + "." for _ in range(n))
import tokenizers
before = held()
model = packing.word_ids({PATH!r})
for _ in range(200):
    model.encode(words(3000))
print(held() - before)
"""
    grown = subprocess.run([sys.executable, "-c", work], capture_output=True, text=True, check=True).stdout
    assert int(grown) < 190_000, grown  # KB
