"""Operator 7, language-model scoring by context-tree weighting over bytes (see context_tree).

The corpus is dealt into blocks of some megabytes by doc_id. Each block counts its grams (context bytes and the byte that
follows) and its words, and sends them to the shards of their keys as packed arrays: one row for each block and shard.
A shard merges the counts of all blocks, builds its part of the trees, and answers each block with one value per key in the
block's own order, so keys travel once. Shards hold whole contexts of two bytes; those that hold over HOT_BYTES of the
corpus are divided by the byte before, and so on, so that no context makes one shard heavy. The nodes above the shards (depth 0
and 1: 65,792 places at most; and those of the divided contexts, 255 for each of HOT_MOST a depth at most) are summed over the
shards and handed to all. Blocks then score their documents against the values they got. No table that grows with the corpus
is broadcast, and nothing is dropped: rare contexts and words are counted like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix64, saved
from .context_tree import END as LAST
from .context_tree import TOP, Counter, Cuts, DividedNodes, KeyTable, TopNodes, context_of, deep, gram_codes, tally

#: Bytes of text in a block, about; the least number of blocks; bytes of text for each shard, and the least number of these.
BLOCK_BYTES, MIN_BLOCKS, SHARD_BYTES, MIN_SHARDS = 16_000_000, 8, 16_000_000, 32
#: A context is divided if it stands before more bytes than this, and more than one in HOT_MOST of the corpus.
HOT_BYTES, HOT_MOST = 16_000_000, 4096
#: Bytes of text whose grams are taken at a time.
CHUNK = 2_000_000
#: Stands for the end of a document among the hashes of words.
END = U64(0x8CB92BA72F3D8DD7)
#: The bytes that part words, by byte; words of more bytes than LONG are hashed one by one.
SPACE, LONG = np.isin(np.arange(256), [*b" \t\n\r\x0b\x0c"]), 64


def pack(x: np.ndarray) -> bytes:
    """An array of 64-bit integers as differences, byte by byte in planes: what is small compresses."""
    x = x.astype(np.int64)
    return np.diff(x, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64))


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= CHUNK:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts and of each one's end, in order, and where each text begins."""
    raw = np.frombuffer(b"\n".join([b"", *texts, b"\0" * 8]), dtype=np.uint8)  # a space before and after each text
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    space = SPACE[raw[: ends_of_texts[-1] + 1]]
    starts, ends = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
    n = np.searchsorted(starts, ends_of_texts)
    is_word = np.ones(len(starts) + len(texts), dtype=bool)
    is_word[n + np.arange(len(texts))] = False
    keys = np.full(len(is_word), END)
    keys[is_word] = _hashes(raw, starts, ends - starts)
    return keys, np.concatenate([[0], n[:-1] + np.arange(1, len(texts))])


def _hashes(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words that begin at starts, eight bytes of all at a time; at least eight bytes follow the last word."""
    import xxhash

    eight = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)
    out, left = mix64(sizes.astype(U64)), np.flatnonzero(sizes <= LONG)
    for at in range(0, LONG, 8):
        left = left[sizes[left] > at]
        out[left] = mix64(out[left] ^ (eight[starts[left] + at] & masks[np.minimum(sizes[left] - at, 8)]))
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : starts[i] + sizes[i]])
    return out


def _spread(begins: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(begins, n)))


def block_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all bytes of some texts and of each one's end, in order, and where each text begins."""
    return gram_codes([t + LAST for t in texts], depth)


#: Each byte as itself, A-Z in lower case.
LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


def hot_contexts(rows: DataFrame, depth: int, least: int) -> Cuts:
    """The contexts of `rows` (text) that stand before more than `least` bytes: those of TOP bytes, of these the ones a byte longer, ...

    They are counted over the texts of an Arrow batch one after the other; where trees are cut changes no result.
    """
    hot: dict[int, np.ndarray] = {}
    for length in range(TOP, depth):

        def run(batches: Iterator, length: int = length, hot: dict = dict(hot)) -> Iterator:
            import pyarrow as pa

            divided = {d: np.isin(np.arange(1 << 8 * TOP, dtype=U64), c) if d == TOP else np.sort(c) for d, c in hot.items()}
            pairs, longer = np.zeros(1 << 8 * TOP, dtype=np.int64), Counter()
            for batch in batches:
                column = batch.column(0).cast(pa.large_binary())
                offsets, data = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :], column.buffers()[2]
                raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[len(column)]] if data else np.empty(0, dtype=np.uint8)
                for at in range(0, len(raw), CHUNK):
                    part = LOWER[raw[max(0, at - depth) : at + CHUNK]]
                    two = part[:-1].astype(np.uint16) << 8 | part[1:]
                    if length == TOP:
                        pairs += np.bincount(two, minlength=len(pairs))
                        continue
                    ends = np.flatnonzero(divided[TOP][two]) + 1
                    context, size = two[ends - 1].astype(U64), TOP
                    while size < length:
                        ends, context = ends[ends >= size], context[ends >= size]
                        context |= part[ends - size].astype(U64) << U64(8 * size)
                        size += 1
                        if size < length:
                            at_size = divided[size]
                            on = at_size[np.minimum(np.searchsorted(at_size, context), len(at_size) - 1)] == context
                            ends, context = ends[on], context[on]
                    found, n = np.unique(context, return_counts=True)
                    longer.add(found, n)
            keys, n = (np.flatnonzero(pairs), pairs[pairs > 0]) if length == TOP else longer.all()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64), pa.int64()), pa.array(n, pa.int64())], names=["context", "n"])

        counted = rows.select("text").mapInArrow(run, "context long, n long").groupBy("context").agg(F.sum("n").alias("n"))
        top = [r["context"] for r in counted.where(F.col("n") > least).collect()]  # each holds a share of the corpus: HOT_MOST at most
        if not top:
            break
        hot[length] = np.array(top, dtype=np.int64).view(U64)
    return Cuts(hot)


def block_counts(texts: list[bytes], train: np.ndarray, depth: int, shards: int, cuts: Cuts) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of the grams and of the words of a block: keys in order, counts, the keys' places by shard and key, and where each shard begins among these."""
    grams, words = Counter(), Counter()
    for a, b in chunks(texts):
        for counter, (keys, begins) in ((grams, block_grams(texts[a:b], depth)), (words, word_keys(texts[a:b]))):
            counter.add(*tally(keys, _spread(begins, len(keys), train[a:b])))
    out = []
    for counter, shard_of in ((grams, lambda keys: cuts.shards(keys, shards)), (words, lambda keys: keys % U64(shards))):
        keys, counts = counter.all()
        shard = shard_of(keys)
        order = np.argsort(shard.astype(np.int64), kind="stable")
        out.append((keys, counts, order, np.searchsorted(shard[order], np.arange(shards + 1, dtype=U64))))
    return out


def _train(doc_id):
    """False for the documents held out: crc32 of doc_id's decimal digits mod 7 is 2. A null doc_id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


def score_documents(docs: DataFrame, depth: int = 5) -> DataFrame:
    """Per row of docs: doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    score: log10 probability of the text's bytes, A-Z in lower case, and of its end, under the context-tree model of the training
    documents' bytes; base_score: of its words and its end under add-one counts. bits_per_byte: the code length that score stands
    for, per byte of text. Null text: empty, one token, and no bits_per_byte. A null doc_id is trained on; repeated rows are documents of their own. Texts are whole; without
    training documents all predictions are even. Other columns play no part; an empty table gives an empty table.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, shards = max(MIN_BLOCKS, -(-total // BLOCK_BYTES)), max(MIN_SHARDS, -(-total // SHARD_BYTES))
    cuts = hot_contexts(rows, depth, max(HOT_BYTES, total // HOT_MOST))
    rows = rows.withColumn("train", _train(F.col("doc_id"))).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def read(table) -> tuple[list[bytes], np.ndarray]:
        import pyarrow as pa

        return [t.lower() for t in table["text"].cast(pa.binary()).to_pylist()], table["train"].to_numpy().astype(np.int64)

    def count(key, table):
        import pyarrow as pa

        out = {n: [] for n in ("shard", "g_keys", "g_counts", "w_keys", "w_counts")}
        (grams, g_counts, g_order, g_at), (words, w_counts, w_order, w_at) = block_counts(*read(table), depth, shards, cuts)
        for s in range(shards):
            g, w = g_order[g_at[s] : g_at[s + 1]], w_order[w_at[s] : w_at[s + 1]]
            if len(g) or len(w):
                row = (s, pack(grams[g]), pack(g_counts[g]), pack(words[w].view(np.int64)), pack(w_counts[w]))
                for column, x in zip(out.values(), row):
                    column.append(x)
        return pa.table({"block": pa.array([key[0].as_py()] * len(out["shard"]), pa.int32()), "shard": pa.array(out.pop("shard"), pa.int32()), **{k: pa.array(v, pa.binary()) for k, v in out.items()}})

    # A partition for each block and each shard, whatever the session's setting: no task holds two by chance.
    counted = rows.repartitionById(blocks, "block").groupBy("block").applyInArrow(count, "block int, shard int, g_keys binary, g_counts binary, w_keys binary, w_counts binary")

    def merge(table):
        import pyarrow as pa

        def joined(keys: str, counts: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
            parts = [unpack(x).view(U64) for x in table[keys].to_pylist()]
            merged, of = np.unique(np.concatenate(parts), return_inverse=True)
            n = np.bincount(of, np.concatenate([unpack(x) for x in table[counts].to_pylist()]), len(merged))
            return merged, n, np.split(of, np.cumsum([len(p) for p in parts])[:-1])

        grams, n, g_of = joined("g_keys", "g_counts")
        words, c, w_of = joined("w_keys", "w_counts")
        lengths, predicted = cuts.lengths(grams), np.ones((len(grams), 8))
        sums = {k: [] for k in ("length", "key", "n0", "n1", "logs")}
        for d in np.unique(lengths).tolist():
            on = lengths == d
            predicted[on], nodes = deep(grams[on], n[on], depth, d)
            upper = ((nodes["context"].astype(np.int64) & ((1 << 8 * (d - 1)) - 1)) << 8) | nodes["place"].astype(np.int64)
            key, at = np.unique(upper, return_inverse=True)
            for k, x in (("length", np.full(len(key), d - 1)), ("key", key), *((c, np.bincount(at, nodes[c], len(key))) for c in ("n0", "n1", "logs"))):
                sums[k].append(x)
        flat = {k: pa.array([np.concatenate(x).tolist() if x else []], pa.list_(pa.int64() if k in ("length", "key") else pa.float64())) for k, x in sums.items()}
        return pa.table({
            "shard": table["shard"][:1], "blocks": pa.array([table["block"].to_pylist()], pa.list_(pa.int32())), "grams": pa.array([grams.tobytes()], pa.binary()), "predicted": pa.array([predicted.astype(np.float32).tobytes()], pa.binary()),
            "g_of": pa.array([[pack(x) for x in g_of]], pa.list_(pa.binary())), "w_counts": pa.array([[pack(c[x].astype(np.int64)) for x in w_of]], pa.list_(pa.binary())),
            **flat, "tokens": pa.array([int(c.sum())], pa.int64()), "types": pa.array([int((c > 0).sum())], pa.int64()),
        })

    schema = "shard int, blocks array<int>, grams binary, predicted binary, g_of array<binary>, w_counts array<binary>, length array<long>, key array<long>, n0 array<double>, n1 array<double>, logs array<double>, tokens long, types long"
    model = saved(counted.repartitionById(shards, "shard").groupBy("shard").applyInArrow(merge, schema), "model")
    upper = model.select(F.explode(F.arrays_zip("length", "key", "n0", "n1", "logs")).alias("x")).groupBy("x.length", "x.key").agg(*[F.sum(f"x.{c}").alias(c) for c in ("n0", "n1", "logs")]).toPandas()  # the nodes above the shards
    n_train, n_types = model.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    divided = DividedNodes({int(d): tuple(part[c].to_numpy() for c in ("key", "n0", "n1", "logs")) for d, part in upper.groupby("length")})
    low = divided.low[0].astype(np.int64)
    top = TopNodes(low >> 8, low & 255, *divided.low[1:])

    def answer(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                grams = np.frombuffer(row["grams"], dtype=U64)
                values = divided.mixed(grams, cuts.lengths(grams), np.frombuffer(row["predicted"], dtype=np.float32).reshape(-1, 8).astype(np.float64))
                values = top.log10(grams, values).astype(np.float32)
                n = len(row["blocks"])
                answers = [values[unpack(x)].tobytes() for x in row["g_of"]]
                yield pa.RecordBatch.from_arrays([pa.array(row["blocks"], pa.int32()), pa.array([row["shard"]] * n, pa.int32()), pa.array(answers, pa.binary()), pa.array(row["w_counts"], pa.binary())], names=["to_block", "shard", "g_values", "w_counts"])

    answers = model.select("shard", "blocks", "grams", "predicted", "g_of", "w_counts").mapInArrow(answer, "to_block int, shard int, g_values binary, w_counts binary")

    def score(left, right):
        import pyarrow as pa

        texts, train = read(left)
        (grams, _, g_order, _), (words, _, w_order, _) = block_counts(texts, train, depth, shards, cuts)
        got = sorted(right.to_pylist(), key=lambda r: r["shard"])
        g_values, w_values = np.empty(len(g_order)), np.empty(len(w_order), dtype=np.int64)
        g_values[g_order] = np.concatenate([np.frombuffer(r["g_values"], dtype=np.float32) for r in got])
        w_values[w_order] = np.concatenate([unpack(r["w_counts"]) for r in got])
        out = np.zeros((len(texts), 4))
        gram_table, word_table, scale = KeyTable(grams), KeyTable(words), np.log10(max(1, n_train + n_types + 1))
        for a, b in chunks(texts):
            codes, begins = block_grams(texts[a:b], depth)
            sums = np.concatenate([[0.0], np.cumsum(g_values[gram_table.find(codes)])])
            out[a:b, 0] = sums[np.append(begins[1:], len(codes))] - sums[begins]
            keys, begins = word_keys(texts[a:b])
            c = w_values[word_table.find(keys)]
            out[a:b, 1] = np.diff(np.append(begins, len(keys)))
            out[a:b, 2] = np.add.reduceat(c > 0, begins, dtype=np.int64)
            out[a:b, 3] = np.add.reduceat(np.log10(c + 1.0) - scale, begins)
        n_bytes = np.array([len(t) for t in texts])
        bits = [-x / np.log10(2) / n if n else None for x, n in zip(out[:, 0].tolist(), n_bytes.tolist())]
        return pa.table({
            "doc_id": left["doc_id"], "held_out": pa.array(train == 0), "n_bytes": pa.array(n_bytes), "n_tokens": pa.array(out[:, 1].astype(np.int64)), "n_known": pa.array(out[:, 2].astype(np.int64)),
            "train_tokens": pa.array([n_train] * len(texts), pa.int64()), "base_score": pa.array(out[:, 3]), "score": pa.array(out[:, 0]), "bits_per_byte": pa.array(bits, pa.float64()),
        })

    schema = "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return rows.repartitionById(blocks, "block").groupBy("block").cogroup(answers.repartitionById(blocks, "to_block").groupBy("to_block")).applyInArrow(score, schema)
