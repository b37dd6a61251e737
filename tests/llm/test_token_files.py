"""Token files: cost of the coder, damage, words coded together, a word memory that forgets."""

import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from perron.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def zipf(n, ids, seed=1):
    return np.minimum(np.random.default_rng(seed).zipf(1.3, n), ids).astype(np.uint32) - 1


def test_coder_cost():
    """Some half a microsecond an id is usual; an update after every id took ten times that."""
    block = zipf(token_files.FILE_IDS // 2, 49_408)[None, :]
    start = time.process_time()
    packed = token_files.encode_blocks(block, 49_408)
    assert (token_files.decode_blocks(packed, block.shape[1], 49_408) == block).all()
    assert time.process_time() - start < 2.5e-6 * block.size
    assert len(packed[0]) < 4 * block.size / 2


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 257, 5000, 300_001])
@pytest.mark.parametrize("ids", [1, 3, 70_000])
def test_coder_lengths(n, ids):
    blocks = np.stack([zipf(n, ids), np.full(n, ids - 1, np.uint32), np.random.default_rng(2).integers(0, ids, n).astype(np.uint32)])
    packed = token_files.encode_blocks(blocks, ids)
    assert (token_files.decode_blocks(packed, n, ids) == blocks).all()


def test_damage(tmp_path):
    """Every byte counts, also the last ones and those that are missing."""
    path = tmp_path / "a.ids"
    token_files.write_file(str(path), [1], [zipf(3000, 500)], 500)
    data = path.read_bytes()
    for at in [*range(-60, 0), *range(-len(data) // 2, -60, 97)]:
        broken = bytearray(data)
        broken[at] ^= 1
        path.write_bytes(broken)
        with pytest.raises(ValueError, match="broken block"):
            list(token_files.read_file(str(path)))
    path.write_bytes(data[:-7])
    with pytest.raises(ValueError, match="broken block"):
        list(token_files.read_file(str(path)))


class Counted(token_files.WordIds):
    MOST, TOGETHER = 300, 40
    calls = 0

    def _encoded(self, texts):
        self.calls += len(texts)
        return super()._encoded(texts)


@pytest.mark.parametrize("together", [True, False])
def test_words(together):
    with open(PATH, "rb") as f:
        tokenizer = f.read()
    words = Counted(tokenizer)
    library = Tokenizer.from_buffer(tokenizer)
    if not together:
        words.between = None
    rng = np.random.default_rng(3)
    letters = list("abcdefghij")
    made = ["".join(rng.choice(letters, 6)) for _ in range(2000)]
    texts = [" ".join(rng.choice(made, 30)) for _ in range(60)]
    texts += [None, "", " \t\n\x0b\x0c\r ", " a  b ", "\x01", "a\x01b \x01 \x01\x02 c", "J̌ ́x é y \x1c z", "Don't <|endoftext|>x, it's 1234 日本語"] * 2
    words.calls = 0
    for i in range(0, len(texts), 7):
        got = words.of(texts[i : i + 7])
        assert [g.tolist() for g in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts[i : i + 7]]
        assert len(words.place) < words.MOST + 7 * 31 and len(words.begins) == len(words.place) + 1 == len(words.uses) + 1
    if together:
        assert words.calls < 400  # some 1,700 words
    assert words.of([]) == []
