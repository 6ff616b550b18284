"""A join of per-document word frequencies with something that is worked out
once for each distinct word of the corpus, and sums of it by document.

Documents are handled in blocks, each of a bounded size.  A block keeps its
postings (which documents have which word how often), packed; what it asks for is
one entry for each of its distinct words, dealt by the word's hash into P frames.
Frames of one hash from all blocks meet in one task, where each distinct word is
valued once, and the values go back to the block in the order it asked.  So a
frequent word has one small entry for each block, whatever its number of
documents, and no task ever holds the postings of a word.  Rows are sorted within
their partition before they are read, so that a task holds its distinct words,
a part of the questions, and one block at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: A block ends at so many bytes of text or documents.
BLOCK_BYTES, BLOCK_DOCS = 16_000_000, 16_384
#: Words that a task looks up at once, at least.
AT_ONCE = 1_000_000
#: Kinds of rows, in the order in which a partition is read.
TOTALS, WORDS, BLOCK, ANSWER, BESIDE = 0, 1, 2, 3, 4
FRAME = "home long, block long, kind int, body binary"


def _pack(*arrays) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return pickle.dumps((len(raw), pa.compress(raw, codec="zstd", asbytes=True)))


def _unpack(body: bytes):
    size, data = pickle.loads(body)
    return pickle.loads(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True))


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


def _planes(x: np.ndarray) -> tuple[str, np.ndarray]:
    """Whole numbers byte by byte, which packs better: most high bytes are zero."""
    x = _small(x)
    return x.dtype.str, np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)


def _whole(planes: tuple[str, np.ndarray]) -> np.ndarray:
    kind, bytes_of = planes
    return np.ascontiguousarray(bytes_of.T).view(kind).ravel().astype(np.int64)


def _frame(home: int, block: int, kind: int, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([home], pa.int64()), pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([body], pa.binary())], ["home", "block", "kind", "body"])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in range(4))


def _words(joined: bytes, lengths: np.ndarray) -> pa.LargeBinaryArray:
    offsets = np.append(0, np.cumsum(lengths.astype(np.int64)))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])


def _block(block: int, parts: int, ids: list, tags: list, flags: list, texts: list[bytes], tokens: Callable[[bytes], list[bytes]], beside: Callable | None) -> Iterator[pa.RecordBatch]:
    found = [tokens(x) for x in texts]
    counts = np.array([len(x) for x in found], np.int64)
    coded = pa.array([w for x in found for w in x], pa.binary()).dictionary_encode()
    del found
    words, n = coded.dictionary.to_pylist(), len(texts)
    code = coded.indices.to_numpy().astype(np.int64)
    if beside is not None:  # also for blocks without words
        yield _frame(0, block, BESIDE, _pack(ids, tags, flags, *beside(words, code, counts)))
    pid = np.array([crc32(w) for w in words], np.int64) % parts
    order = np.argsort(pid, kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    key, freq = np.unique(place[code] * max(n, 1) + np.repeat(np.arange(n), counts), return_counts=True)
    word, doc = np.divmod(key, max(n, 1))
    postings = np.bincount(word, minlength=len(words))
    step = np.diff(doc, prepend=0)
    first = (np.cumsum(postings) - postings).astype(np.int64)
    step[first] = doc[first]  # each word's first document, then the steps to the next ones
    asked, sizes = np.unique(pid, return_counts=True)
    yield _frame(block, block, BLOCK, _pack(ids, tags, flags, [len(x) for x in texts], counts, asked, sizes, _planes(postings), _planes(step), _planes(freq)))
    flagged = np.bincount(word, freq * np.array(flags, bool)[doc], len(words)).astype(np.int64) if len(words) else np.empty(0, np.int64)
    for p, some in zip(asked, np.split(order, np.cumsum(sizes)[:-1])):
        mine = [words[i] for i in some]
        yield _frame(int(p), block, WORDS, _pack(b"".join(mine), _small(np.array([len(w) for w in mine])), _small(flagged[place[some]])))


def _deal(parts: int, tokens: Callable[[bytes], list[bytes]], make_beside: Callable[[], Callable] | None):
    def rows(batches):
        beside = make_beside() if make_beside else None
        task, number = TaskContext.get(), 0
        first = (task.partitionId() if task else 0) << 20
        ids, tags, flags, texts, size = [], [], [], [], 0
        for batch in batches:
            for i, tag, text, flag in zip(*(batch.column(c).to_pylist() for c in range(4))):
                text = text or b""
                if texts and (size + len(text) > BLOCK_BYTES or len(texts) >= BLOCK_DOCS):
                    yield from _block(first + number, parts, ids, tags, flags, texts, tokens, beside)
                    ids, tags, flags, texts, size, number = [], [], [], [], 0, number + 1
                ids.append(i)
                tags.append(tag)
                flags.append(bool(flag))
                texts.append(text)
                size += len(text)
        if texts:
            yield from _block(first + number, parts, ids, tags, flags, texts, tokens, beside)

    return rows


def _grouped(frames: Iterator[tuple], least: Callable[[], int]) -> Iterator[list[tuple]]:
    """Frames (.., words, ..) in runs of at least ``least()`` words."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame[1])
        if size >= least():
            yield held
            held, size = [], 0
    if held:
        yield held


def _totals(batches):
    """The distinct words of a partition with their counts in flagged documents."""
    words, counts, home = pa.array([], pa.large_binary()), np.empty(0, np.int64), 0
    frames = ((f[0], _words(b[0], b[1]), b[2]) for f in _rows(batches) for b in [_unpack(f[3])])
    for run in _grouped(frames, lambda: max(AT_ONCE, len(words))):
        home = run[0][0]
        both = pa.chunked_array([words, *(w for _, w, _ in run)]).combine_chunks().dictionary_encode()
        words, counts = both.dictionary, np.bincount(both.indices.to_numpy(), np.concatenate([counts, *(c for *_, c in run)]), len(both.dictionary)).astype(np.int64)
    for a in range(0, len(words), AT_ONCE):
        some = words.slice(a, AT_ONCE).to_pylist()
        yield _frame(home, -1, TOTALS, _pack(b"".join(some), _small(np.array([len(w) for w in some])), _small(counts[a : a + AT_ONCE])))


def _answers(make_weigh, width: int):
    """The values of the words that blocks ask for, each distinct word valued
    once; before them, where there are any, come the words' counts."""

    def rows(batches):
        weigh = make_weigh()
        known, values = pa.array([], pa.large_binary()), np.empty((0, width))

        def learn(words: pa.Array, counts: np.ndarray | None) -> None:
            nonlocal known, values
            known = pa.chunked_array([known, words]).combine_chunks()
            values = np.concatenate((values, weigh(words.to_pylist(), counts)))

        def asked():
            for home, block, kind, body in _rows(batches):
                joined, lengths, counts = _unpack(body)
                if kind == TOTALS:
                    learn(_words(joined, lengths), counts.astype(np.int64))
                    yield home, [], None, (float(counts.sum(dtype=np.float64)), int((counts > 0).sum()))
                else:
                    yield home, _words(joined, lengths), block, None

        for run in _grouped(asked(), lambda: max(AT_ONCE, len(known))):
            for home, _, block, total in run:
                if block is None:
                    yield _frame(home, -1, TOTALS, _pack(*total))
            questions = [f for f in run if f[2] is not None]
            if not questions:
                continue
            coded = pa.chunked_array([w for _, w, _, _ in questions]).combine_chunks().dictionary_encode()
            at = pc.index_in(coded.dictionary, value_set=known)
            if at.null_count:
                learn(coded.dictionary.filter(pc.is_null(at)), None)
                at = pc.index_in(coded.dictionary, value_set=known)
            found, start = values[at.to_numpy()][coded.indices.to_numpy()], 0
            for home, w, block, _ in questions:
                mine = found[start : start + len(w)]
                start += len(w)
                whole = (mine == np.round(mine)).all() and mine.min() >= 0
                yield _frame(block, block, ANSWER, _pack(home, _small(mine.astype(np.int64).ravel()) if whole else mine.ravel()))

    return rows


def _sum_up(width: int):
    fields = [("doc_id", pa.int64()), ("tag", pa.int64()), ("flag", pa.bool_()), ("n_bytes", pa.int64()), ("n_words", pa.int64()), *((f"v{k}", pa.float64()) for k in range(width)), ("total", pa.float64()), ("distinct", pa.int64())]
    schema = pa.schema(fields)

    def done(meta, answers: dict[int, np.ndarray]):
        ids, tags, flags, sizes, counts, asked, _, postings, step, freq = meta
        n, postings = len(ids), _whole(postings)
        out = np.zeros((width, n))
        if len(postings):
            step, freq = _whole(step), _whole(freq)
            first = np.cumsum(postings) - postings
            run = np.cumsum(step)
            doc = run - np.repeat(run[first] - step[first], postings)
            values = np.concatenate([answers[int(p)] for p in asked]).astype(np.float64).reshape(-1, width)
            for k in range(width):
                out[k] = np.bincount(doc, np.repeat(values[:, k], postings) * freq, n)
        columns = [ids, tags, flags, sizes, counts, *out, np.zeros(n), np.zeros(n, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def rows(batches):
        meta, answers, total, distinct = None, {}, 0.0, 0
        for _, block, kind, body in _rows(batches):
            if kind == TOTALS:
                t, d = _unpack(body)
                total, distinct = total + t, distinct + d
            elif kind == BLOCK:
                if meta is not None:
                    yield done(meta, answers)
                meta, answers = _unpack(body), {}
            else:
                home, values = _unpack(body)
                answers[home] = values
        if meta is not None:
            yield done(meta, answers)
        nothing = [pa.array([None], f.type) for f in schema]
        yield pa.RecordBatch.from_arrays([*nothing[:-2], pa.array([total]), pa.array([distinct], pa.int64())], schema=schema)

    return rows, "doc_id long, tag long, flag boolean, n_bytes long, n_words long, " + "".join(f"v{k} double, " for k in range(width)) + "total double, distinct long"


def sums_by_document(docs: DataFrame, tokens: Callable[[bytes], list[bytes]], make_weigh: Callable[[], Callable], width: int, make_beside: Callable[[], Callable] | None = None, counted: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """``docs``: doc_id long, tag long, text binary, flag boolean.

    ``tokens`` cuts a text into words.  ``make_weigh()`` gives in each task a
    function of distinct words and, if ``counted``, their counts in flagged
    documents, which returns ``width`` values for each word.  The first result has
    a row for each document (doc_id, tag, flag, n_bytes, n_words, v0 ...: sums of
    frequency times value), and rows with n_bytes null, whose total and distinct sum
    up, if ``counted``, to the words in flagged documents and the distinct ones
    among them.

    ``make_beside()`` gives in each task a function of a block's distinct words,
    each word's number in turn and each document's number of words; what it
    returns is packed, after the documents' ids, tags and flags, into the second
    result, one row (body) for each block, kept in the shared folder.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, "words")
    dealt = docs.select("doc_id", "tag", "text", "flag").mapInArrow(_deal(parts, tokens, make_beside), FRAME)
    dealt.write.partitionBy("kind").option("parquet.enable.dictionary", "false").parquet(path)
    kept = spark.read.schema(FRAME).parquet(path).select("home", "block", "kind", "body")
    of = lambda kind: kept.where(F.col("kind") == kind)
    at = lambda df, home: df.withColumn("to", F.expr(home).cast("int")).repartitionById(parts, "to")
    questions = of(WORDS)
    if counted:
        totals = at(questions, "home").select("home", "block", "kind", "body").mapInArrow(_totals, FRAME)
        questions = totals.unionByName(questions)
    met = at(questions, "home").sortWithinPartitions("kind").select("home", "block", "kind", "body")
    answers = met.mapInArrow(_answers(make_weigh, width), FRAME)
    rows, schema = _sum_up(width)
    back = at(of(BLOCK).unionByName(answers), f"pmod((home >> 20) * 7 + (home & 1048575), {parts})")
    out = back.sortWithinPartitions("block", "kind").select("home", "block", "kind", "body").mapInArrow(rows, schema)
    return out, of(BESIDE).select("body") if make_beside is not None else None
