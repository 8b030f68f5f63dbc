"""run() against the stages written plainly, on a small table."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

import corpus_pipeline
from tideline.llm.queries import tokenizer_path

from .conftest import words
from .plain import line_fails


def documents():
    rng = random.Random(11)
    passage, line = words(rng, 50), "All of these share this one line."
    texts = ["\n".join(words(rng, rng.randint(8, 20)) + "." for _ in range(rng.randint(6, 14))) for _ in range(24)]
    texts += [texts[0], texts[1].replace(" ", " very ", 1), " ".join(texts[2].split()[3:]), "short one.", None, "", "x### " * 80, "word " * 100]
    texts += [t + "\n" + line + "\n" + line.upper() for t in ("\n".join(words(rng, 15) + "." for _ in range(8)) for _ in range(5))]
    texts += [words(rng, 60) + ". " + passage + " " + words(rng, 60) + "." for _ in range(4)]
    texts += [words(rng, 5000) + "."]
    texts += ["Home\nAbout\n=====\n" + "\n".join(words(rng, 12) + "." for _ in range(8)) + "\nAll rights reserved.", "\n".join(["Read more", "about us: follow us on this and that"] * 40)]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def quality(docs):
    out = {}
    for d, t in docs.items():
        w, kept, lost = (t or "").encode().split(), [], 0
        seen = Counter(zip(w, w[1:], w[2:]))
        repeated = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        for x in (t or "").split("\n"):
            if line_fails(x):
                lost += len(x.encode().split())
            else:
                kept.append(x)
        if len(w) >= 50 and 2 * len(repeated) <= len(w) and 2 * lost <= len(w):
            out[d] = "\n".join(kept)
    return out


def lines(docs):
    key = lambda x: x.encode().strip().lower().decode()
    holders = defaultdict(set)
    for d, t in docs.items():
        for x in t.split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(d)
    return {d: "\n".join(x for x in t.split("\n") if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == d) for d, t in docs.items()}


def near(docs):
    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets, label = {d: shingles(t) for d, t in docs.items()}, {d: d for d in docs}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in docs:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {d: t for d, t in docs.items() if label[d] == d}


def substrings(docs):
    split, where = {d: t.encode().split() for d, t in docs.items()}, Counter()
    for w in split.values():
        where.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    out = {}
    for d, w in split.items():
        gone = {j for i in range(len(w) - 34) if where[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        out[d] = b" ".join(x for i, x in enumerate(w) if i not in gone).decode() if gone else docs[d]
    return out


def test_run_equals_plain_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = {r[0]: r[1] for r in rows}
    sizes = []
    for stage in (quality, lines, near, substrings):
        docs = stage(docs)
        sizes.append(len(docs))
    assert len(rows) > sizes[0] > sizes[2] > 20
    tokenizer, expected = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), Counter()
    for d, t in docs.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4").tobytes()
            expected[d, piece, at, len(part) // 4, zlib.crc32(part)] += 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 2048


def test_stages_keep_the_columns_of_documents(spark):
    df = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema], name
        assert out.where("n_chars <> length(text)").count() == 0, name


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
