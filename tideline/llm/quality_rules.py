"""Operator 1, quality rules: clean line by line first, then judge the document by what is lost.

Each line is held against three rules: punctuation (symbols, or hardly anything but marks), navigation (rows of
separators, or menu words alone) and boilerplate (phrases of page furniture, one to every few words). Lines that fail are removed; a document that loses more than `max_lost_pct`
percent of its words, or that fails the base limits, is rejected. One pass over the documents, no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sealed, without

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Marks that may end a sentence, a heading or a list line.
ENDS = ".!?:;,\"'”’»…)]。！？"
#: ASCII marks that are neither letter nor digit.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    "accept all cookies", "add to cart", "all rights reserved", "back to top", "click here to", "cookie policy", "enable javascript", "follow us on", "leave a comment", "leave a reply", "log in to comment",
    "lorem ipsum", "page not found", "powered by wordpress", "privacy policy", "read more", "related posts", "share on facebook", "share on twitter", "sign up for our newsletter", "skip to content",
    "subscribe to our", "terms of service", "terms of use", "this site uses cookies", "view cart",
)
#: Words that alone make up a navigation line.
NAVIGATION = ("about", "back", "blog", "contact", "faq", "forward", "help", "home", "login", "logout", "menu", "next", "news", "previous", "register", "search", "share", "sitemap", "top")
#: Separators of a navigation line.
SEPARATORS = "|»›>·•"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules.

    min_words: fewer words in the whole text fail the base. max_repeat_pct: more words than this share in repeated
    3-word windows fail it. max_symbols_per_word: a line with more symbol characters per word fails the punctuation
    rule; so does one of which more than two thirds are marks. min_separators: a line with as many separators, at least one
    to every three words, fails the navigation rule; so does a line of up to max_menu_words navigation words alone that has
    no end mark. words_per_phrase: a line with a phrase of page furniture to every so many words or fewer fails the
    boilerplate rule; a longer text that mentions one does not.
    max_lost_pct: documents losing more of their words are rejected.
    """

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbols_per_word: int = 1
    min_separators: int = 3
    max_menu_words: int = 4
    words_per_phrase: int = 12
    max_lost_pct: int = 50


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "n_lost_words", "base_failed", "kept", "clean_text")
_PHRASES = tuple(p.encode() for p in BOILERPLATE)
_ANY_PHRASE = re.compile(b"|".join(map(re.escape, _PHRASES)))
_NAVIGATION = frozenset(n.encode() for n in NAVIGATION)
_MARKS = MARKS.encode()
_WHITE = b" \t\n\v\f\r"


def line_fails(line: bytes, n_words: int, rules: LineRules) -> bool:
    """Whether a line with n_words > 0 words breaks the punctuation, navigation or boilerplate rule."""
    n = sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    if n > rules.max_symbols_per_word * n_words:
        return True
    text = line.decode("utf-8", "replace").strip(" \t\n\v\f\r")
    solid = line.translate(None, _WHITE)
    marks = len(solid) - len(solid.translate(None, _MARKS))
    if 3 * marks > 2 * len(solid.decode("utf-8", "replace")):
        return True
    separators = sum(map(text.count, SEPARATORS))
    if separators >= rules.min_separators and 3 * separators >= n_words:
        return True
    low = line.lower()
    if n_words <= rules.max_menu_words and text[-1:] not in ENDS and all(w in _NAVIGATION for w in low.split()):
        return True
    return bool(_ANY_PHRASE.search(low)) and n_words <= rules.words_per_phrase * sum(map(low.count, _PHRASES))


def judge(text: bytes, rules: LineRules) -> tuple:
    """What the operator adds to one document, in the order of ADDED without `kept`'s base part separated."""
    words = text.split()
    n = len(words)
    white = sum(map(text.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    chars = len(text.decode("utf-8", "replace")) - white
    symbols = sum(map(text.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    lines, seen, dup, bad, lost, kept = text.split(b"\n"), set(), 0, 0, 0, []
    for line in lines:
        k = len(line.split())
        if k:
            if line in seen:
                dup += 1
            else:
                seen.add(line)
            if line_fails(line, k, rules):
                bad, lost = bad + 1, lost + k
                continue
        kept.append(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, end = Counter(windows), 0
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    failed = n < rules.min_words or 100 * repeated > rules.max_repeat_pct * n
    return n, chars, symbols, dup, repeated, bad, lost, failed, not failed and 100 * lost <= rules.max_lost_pct * n, b"\n".join(kept)


def apply_rules(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """docs with the columns of ADDED; `clean_text` is the text without its failing lines.

    Null text: no words, so it fails the base and clean_text is null. Empty and very long texts are whole texts like
    others; ties and repeated rows are judged each for itself; an empty table gives an empty table. Columns of docs
    that have a name of ADDED are replaced, others are kept as they are.
    """
    docs = without(docs, *ADDED)
    kinds = [T.LongType()] * 7 + [T.BooleanType()] * 2 + [T.StringType()]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(ADDED, kinds)]])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64()] * 7 + [pa.bool_()] * 2
        for batch in batches:
            at = next(i for i, n in enumerate(batch.schema.names) if n.lower() == "text")
            text = batch.column(at).cast(pa.binary()).to_pylist()
            out = [judge(t or b"", rules) for t in text]
            cols = [pa.array([r[i] for r in out], k) for i, k in enumerate(types)]
            cols.append(pa.array([None if t is None else r[9] for t, r in zip(text, out)], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *ADDED])

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with all their columns whatever their names, their failing lines removed from the text; n_chars follows it."""
    inner, opened = sealed(docs, new_text=True)
    return opened(apply_rules(inner, rules).where("kept").withColumn("text", F.col("clean_text")))
