import random

import pytest

SCHEMA = "doc_id long, text string, lang string, n_words string, shard string, key string, kept string, n_lines string, ids string"


def words(rng, n):
    return " ".join(rng.choice(("the", "and", "of")) if rng.random() < 0.3 else "".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Texts with copies, near copies, shared passages and lines, a periodic and a very long text, nulls and repeated rows."""
    rng = random.Random(5)
    passage, line = words(rng, 60), "A line that many of the documents share."
    out = [words(rng, rng.randint(60, 220)) + "." for _ in range(30)]
    out += [out[0], out[0], out[1] + " tail", " ".join("changed" if i == 40 else w for i, w in enumerate(out[2].split()))]
    out += [words(rng, 30) + " " + passage + " " + words(rng, 20) for _ in range(6)]
    out += ["\n".join([words(rng, 12) + ".", line, words(rng, 15) + ".", f"  {line.upper()} ", line]) for _ in range(8)]
    out += ["same word " * 120, words(rng, 30_000), "", " \n\t\n ", None, "one two", "Home | About | Contact | Login\n" * 30, "junk### junk$$$ " * 60]
    out += ["café straße 你好 \U0001f600 <|endoftext|> ▁x é\x00\x85 end. " * 8]
    table = [(i, t, "en", "x", "x", "x", "x", "x", "x") for i, t in enumerate(out)]
    table += [table[3], table[3], (None, out[4], None, "x", "x", "x", "x", "x", "x"), (None, None, None, None, None, None, None, None, None)]
    return table


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
