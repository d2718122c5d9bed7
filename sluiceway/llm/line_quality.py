"""Line-first cleaning: rules per line, then a verdict on what is left of the document.

A line fails when it is mostly punctuation, a navigation bar, or boilerplate. A line may be
a paragraph or a whole document, so each rule goes by the share of the line. Failing
lines are removed. A document is rejected when removal takes more than a given share of
its word characters, or when it fails the base rules on length and repetition.

Defined results: a null text has no words and is rejected as too short; its clean text
is empty. A blank line never fails and is never a duplicate. Texts of any length are
taken whole. Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import BLANKS, free_name

SYMBOLS = "#*$%&|<>"

# Phrases that mark a boilerplate line, lower case.
BOILERPLATE = (
    "licensed under the", "all rights reserved", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "this site uses cookies", "accept cookies",
    "enable javascript", "click here", "subscribe to our newsletter", "sign in to",
    "log in to", "skip to content", "powered by wordpress",
)

# The like in the other languages of the corpus.
BOILERPLATE_ELSEWHERE = (
    "sous licence", "tous droits réservés", "conditions d'utilisation", "conditions d’utilisation",
    "politique de confidentialité", "accepter les cookies", "activer javascript", "cliquez ici",
    "abonnez-vous à notre newsletter", "connectez-vous", "aller au contenu",
    "lizenziert unter", "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung",
    "cookies akzeptieren", "javascript aktivieren", "klicken sie hier", "hier klicken",
    "newsletter abonnieren", "zum inhalt springen",
    "bajo la licencia", "todos los derechos reservados", "términos de uso", "términos de servicio",
    "condiciones de uso", "política de privacidad", "política de cookies", "aceptar cookies",
    "habilitar javascript", "haga clic aquí", "haz clic aquí", "suscríbete a nuestro boletín",
    "iniciar sesión en", "saltar al contenido",
)

# Words of these alone part the entries of a navigation bar.
SEPARATORS = frozenset("/ • · ∙ ‣ ● ▪ ■ ▸ ► → ›".encode().split())


def class_of(*kinds: str) -> str:
    """A pattern for the characters whose Unicode category starts with one of ``kinds``."""
    found, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code)).startswith(kinds)
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            found.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return f"[{''.join(found)}]"


#: Punctuation and symbols: neither letters, digits, marks on letters, nor blanks.
PUNCTUATION = re.compile(class_of("P", "S"))


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict. Shares are in percent."""

    symbol_share: int = 10  # of a line's characters
    punctuation_share: int = 50  # of a line's characters but blanks; more fails
    shout_share: int = 50  # exclamation marks to words
    bars: int = 3  # vertical bars, closing guillemets or separators of a navigation bar, at least
    bar_share: int = 15  # of those to a line's words
    phrases: tuple[str, ...] = BOILERPLATE + BOILERPLATE_ELSEWHERE
    phrase_chars: int = 100  # a line of at most so many characters fails by one phrase
    phrase_share: int = 20  # of a longer line's characters
    lost_share: int = 50  # of a document's word characters
    min_words: int = 50
    repeat_share: int = 50  # of words in repeated windows


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_failed_lines long, lost_chars long, base_failed boolean, kept boolean, clean_text string"
)


def count_of(text: str, characters: str) -> int:
    return sum(map(text.count, characters))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that the list holds at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    if len(number) < 2_000_000:
        codes = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
    else:  # three numbers no longer fit 63 bits
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        codes = pairs[:-1] * len(number) + ids[2:]
    in_order = np.sort(codes)
    repeated = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(repeated):
        return 0
    starts = np.flatnonzero(np.isin(codes, repeated))
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[starts + i] = True
    return int(covered.sum())


def is_navigation(line: str, words: list[bytes], rules: LineRules) -> bool:
    """Whether separators make up enough of a line. A guillemet that closes a quotation is none."""
    bars = line.count("|") + max(0, line.count("»") - line.count("«"))
    alone = sum(map(SEPARATORS.__contains__, words))
    if alone and "‹" in line:
        alone -= min(words.count("›".encode()), line.count("‹"))
    return bars + alone >= rules.bars and 100 * (bars + alone) >= rules.bar_share * len(words)


def is_boilerplate(line: str, rules: LineRules, phrase: re.Pattern[str]) -> bool:
    """Whether a short line has a phrase, or phrases make up enough of a long one."""
    lower = line.lower()
    if len(line) <= rules.phrase_chars:
        return phrase.search(lower) is not None
    return 100 * sum(map(len, phrase.findall(lower))) >= rules.phrase_share * len(lower)


def line_fails(line: str, rules: LineRules, phrase: re.Pattern[str]) -> bool:
    """Whether one line with a word breaks a rule."""
    words = line.encode().split()
    filled = len(line) - count_of(line, BLANKS)
    return (
        100 * count_of(line, SYMBOLS) > rules.symbol_share * len(line)
        or 100 * len(PUNCTUATION.findall(line)) > rules.punctuation_share * filled
        or 100 * line.count("!") >= rules.shout_share * len(words)
        or is_navigation(line, words, rules)
        or is_boilerplate(line, rules, phrase)
    )


def judge(text: str | None, rules: LineRules, phrase: re.Pattern[str]) -> tuple:
    text = text or ""
    words = text.encode().split()
    word_chars = len(text) - count_of(text, BLANKS)
    lines = text.split("\n")
    seen: set[str] = set()
    duplicates = failed = lost = filled = 0
    left = []
    for line in lines:
        if not line.strip(BLANKS):
            left.append(line)
            continue
        filled += 1
        duplicates += line in seen
        seen.add(line)
        if line_fails(line, rules, phrase):
            failed += 1
            lost += len(line) - count_of(line, BLANKS)
        else:
            left.append(line)
    repeats = repeated_words(words)
    base = len(words) < rules.min_words or 100 * repeats > rules.repeat_share * len(words)
    kept = not base and 100 * lost <= rules.lost_share * word_chars
    return (len(words), word_chars, count_of(text, SYMBOLS), duplicates, repeats, filled, failed, lost,
            base, kept, "\n".join(left))


def clean_lines(
    docs: DataFrame, *, text: str = "text", into: str = "quality", rules: LineRules = LineRules(),
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with a struct column ``into`` of counts, verdict and cleaned text.

    An existing column called ``into`` is not touched: the name gets underscores until it
    is free (``free_name`` tells which). Rows are judged one by one, without a shuffle.
    """
    names = [field.strip().split(" ")[0] for field in SCHEMA.split(",")]
    kept_names = names if with_text else names[:-1]
    schema = SCHEMA if with_text else SCHEMA.rsplit(",", 1)[0]

    @F.pandas_udf(schema)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        phrase = re.compile("|".join(map(re.escape, rules.phrases)) or r"(?!)")
        for batch in batches:
            rows = [judge(one, rules, phrase)[: len(kept_names)] for one in batch]
            yield pd.DataFrame(rows, columns=kept_names)

    # Not deterministic in name only: otherwise a filter on the verdict is pushed below
    # this column and every text is judged twice.
    return docs.withColumn(free_name(docs.columns, into), judged.asNondeterministic()(F.col(text).cast("string")))


def keep_clean(docs: DataFrame, *, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """Documents that pass, with failing lines removed; the columns of ``docs``.

    A column ``n_chars`` is set to the new length.
    """
    mark = free_name(docs.columns, "quality")
    found = clean_lines(docs, text=text, into="quality", rules=rules).where(F.col(f"{mark}.kept"))
    found = found.withColumn(text, F.col(f"{mark}.clean_text"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)
