import numpy as np
import pyarrow as pa

from sluiceway.llm import byte_bpe


def test_texts_become_strings_block_by_block():
    texts = ["a" * 10] * 7 + [None, "", "é" * 100] + ["b"] * 5
    blocks = list(byte_bpe.text_blocks(pa.array(texts), 35))
    assert [one for block in blocks for one in block] == [text or "" for text in texts]
    assert all(len(block) == 1 or sum(map(len, block)) <= 35 for block in blocks)
    assert ["é" * 100] in blocks and list(byte_bpe.text_blocks(pa.array([], pa.string()), 35)) == []


def test_id_lists_keep_empty_texts():
    found = byte_bpe.id_lists([np.array([1, 2], np.int32), np.zeros(0, np.int32), np.array([3], np.int32)])
    assert found.to_pylist() == [[1, 2], [], [3]] and found.type == pa.list_(pa.int32())
