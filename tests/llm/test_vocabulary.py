"""Vocabularies that rank-synchronous merging would count wrongly are refused."""

import json

import public_tokenizers
import pytest

from sluiceway.llm.token_counts import Merges

PATH = public_tokenizers.path("byte_bpe_50k.json")


def changed(tmp_path, change):
    with open(PATH, encoding="utf-8") as file:
        found = json.load(file)
    change(found)
    (tmp_path / "own.json").write_text(json.dumps(found))
    return str(tmp_path / "own.json")


@pytest.mark.parametrize("change", [
    lambda one: one["model"].update(ignore_merges=True),
    lambda one: one["model"].update(dropout=0.1),
    lambda one: one["model"].update(end_of_word_suffix="</w>"),
    lambda one: one["pre_tokenizer"].update(use_regex=False),
    lambda one: one["pre_tokenizer"].update(add_prefix_space=True),
    lambda one: one["added_tokens"][0].update(lstrip=True),
    lambda one: one["added_tokens"][0].update(single_word=True),
    lambda one: one["model"]["merges"].reverse(),
    lambda one: one.update(normalizer={"type": "NFC"}),
])
def test_other_rules_are_refused(tmp_path, change):
    with pytest.raises(ValueError):
        Merges.from_file(changed(tmp_path, change), public_tokenizers.PATTERN)


def test_the_file_itself_is_read():
    assert len(Merges.from_file(PATH, public_tokenizers.PATTERN).keys) > 49_000
