"""Token alignment, line dedup and source audit against brute force: the test
documents, hard cases, forced splits."""

import zlib
from collections import Counter

import numpy as np
import pytest

from tabwatch.llm import bpe, line_dedup, source_audit, token_alignment
from tabwatch.llm import queries as Q
from tests.llm import brute
from tests.llm.conftest import HARD, SF

ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
LINES = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
AUDIT = ("lang", "source", "part", "item", "value", "rank")
SCHEMA = "doc_id long, text string, lang string, source string"


def rows(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_aligned_documents(spark, documents):
    assert rows(Q.op11_token_alignment(spark, SF), ALIGNED) == Counter(brute.aligned(documents))


@pytest.mark.parametrize("table", [token_alignment.TABLE, 20, 0])
def test_aligned_hard_cases(hard, table):
    """The same rows whether all pairs, some or none are broadcast."""
    assert rows(token_alignment.align_tokens(hard, table=table), ALIGNED) == Counter(brute.aligned(HARD))


@pytest.mark.parametrize("limits", [{}, {"CROWDED": 1, "PAIRS": 50}, {"SINGLE": 1, "LONG": 5}])
def test_aligned_rows_of_a_task(limits, monkeypatch):
    """What a worker writes, with every group reduced, pairs made in slices, long texts cut."""
    import pyarrow as pa
    for name, value in limits.items():
        monkeypatch.setattr(token_alignment, name, value)
    import public_tokenizers
    aligner = token_alignment.Aligner(bpe.default_files(), public_tokenizers.path(token_alignment.MODEL))
    some = [r for r in HARD if len(r[1] or "") < 10_000]
    batches = list(aligner.align(pa.array(range(len(some))), pa.array([r[0] for r in some], pa.int64()), [aligner.ids(r[1]) for r in some]))
    first = batches[0].to_pydict()
    want = brute.aligned(some)
    assert list(zip(*(first[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")))) == [(*w[:5], w[7]) for w in want]
    assert (len(batches) > 1) == ("PAIRS" in limits) and all(b.column(2).null_count == b.num_rows for b in batches[1:])
    n_links, seen = Counter(), set()
    for b in batches:
        for row, pairs, weights in zip(*(b.column(c).to_pylist() for c in ("row", "pairs", "weights"))):
            n_links[row] += sum(weights)
            assert not seen & {(row, p) for p in pairs}
            seen |= {(row, p) for p in pairs}
    assert [n_links[i] for i in range(len(some))] == [w[4] for w in want]


def leaves(a, b, starts_a, starts_b):
    return list(zip(*(x.tolist() for x in token_alignment.common_intervals(a, b, starts_a, starts_b))))


@pytest.mark.parametrize("seed", range(30))
def test_shared_cuts_by_divide_and_conquer(seed):
    rng = np.random.default_rng(seed)
    ends, at, want, starts = ([], []), 0, [], ([], [])
    for _ in range(int(rng.integers(1, 6))):
        n = int(rng.integers(1, 400))
        sides = [np.unique(np.append(rng.choice(n, int(rng.integers(0, n)), replace=False), n))[1:] if n > 1 else np.array([1]) for _ in range(2)]
        sides = [np.unique(np.append(s[s > 0], n)) for s in sides]
        for side in range(2):
            starts[side].append(len(ends[side]))
        lo = [len(e) for e in ends]
        for cut in sorted(set(sides[0]) & set(sides[1])):
            hi = [starts[k][-1] + int(np.searchsorted(sides[k], cut)) + 1 for k in range(2)]
            want.append((lo[0], hi[0], lo[1], hi[1]))
            lo = hi
        for side in range(2):
            ends[side].extend((sides[side] + at).tolist())
        at += n
    assert leaves(*map(np.array, ends), *map(np.array, starts)) == want


def test_long_interval_without_a_cut():
    """Ends of A and B that never meet but at the borders of a long run."""
    a, b = np.append(np.arange(3, 60_000, 2), 60_001), np.concatenate([[2, 3], np.arange(4, 60_000, 2), [60_001]])
    assert leaves(a, b, np.array([0]), np.array([0])) == [(0, 1, 0, 2), (1, len(a), 2, len(b))]


def test_pairs_in_slices_equal_pairs_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    ids_a, ids_b = rng.integers(0, 9, 600), rng.integers(0, 7, 500)
    groups = tuple(map(np.array, ([0, 1, 300], [1, 300, 600], [0, 4, 200], [4, 200, 500])))
    doc = np.array([0, 0, 1])

    def made():
        return Counter({(d, p): w for x in token_alignment.pair_weights(ids_a, ids_b, groups, doc, 7) for d, p, w in zip(*(c.tolist() for c in x))})

    want = Counter()
    for g in range(3):
        for x in ids_a[groups[0][g]:groups[1][g]]:
            for y in ids_b[groups[2][g]:groups[3][g]]:
                want[int(doc[g]), int(x) * 7 + int(y)] += 1
    assert made() == want
    monkeypatch.setattr(token_alignment, "PAIRS", 10)
    assert made() == want
    monkeypatch.setattr(token_alignment, "CROWDED", 1 << 40)
    assert made() == want


def test_long_texts_are_cut_at_single_spaces(monkeypatch):
    import public_tokenizers
    model = token_alignment.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(token_alignment, "LONG", 7)
    rng = np.random.default_rng(6)
    for _ in range(500):
        text = "".join(rng.choice(["a", "Word", " ", "  ", "\n", "é", "12", "-", "\x00", "the", "<s>"], rng.integers(1, 30)))
        assert model.ids(text) == model.model.encode(text), repr(text)


def test_lines_of_documents(spark, documents):
    assert rows(Q.op12_line_dedup(spark, SF), LINES) == Counter(brute.line_dedup(documents))


def test_hard_lines(spark, hard):
    assert rows(line_dedup.line_counts(hard), LINES) == Counter(brute.line_dedup(HARD))
    out = line_dedup.deduplicated(hard)
    assert out.columns == hard.columns and out.count() == len(HARD)
    kept = Counter((r.doc_id, brute.hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect())
    assert kept == Counter((d, h) for d, _, _, h in brute.line_dedup(HARD))
    assert out.where("text is null").count() == sum(t is None for _, t, *_ in HARD)


@pytest.mark.parametrize("batch", [3, 10_000])
def test_line_of_every_document_over_many_ranges(spark, batch):
    """One line in all documents, others in some; more ranges than distinct lines."""
    data = [(i % 250 if i % 50 else None, "\n".join(["Shared by all of them ", f"line number {i % 7} here", "short", f"own line of {i}", " SHARED by all of them"]), "en", "a")
            for i in range(600)]
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert rows(line_dedup.line_counts(spark.createDataFrame(data, SCHEMA)), LINES) == Counter(brute.line_dedup(data))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bitmaps_of_long_documents(spark):
    text = "\n".join(f"a line that is numbered {i % 50_000}" for i in range(70_000))
    data = [(2, text, "en", "a"), (1, "\n".join(f"A line that is numbered {i}" for i in range(0, 50_000, 3)), "en", "a"), (3, text, "en", "b")]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(line_dedup.line_counts(df), LINES) == Counter(brute.line_dedup(data))
    maps = {r.doc_id: r for r in line_dedup.keep_bitmaps(df).collect()}
    assert set(maps) == {2, 3} and maps[3].n_dropped == 70_000 and sorted(m.block for m in maps[2].maps) == [0, 1, 2]
    assert all(len(m.bits) < line_dedup.CONTAINER // 8 for m in maps[3].maps) and len(zlib.decompress(maps[3].maps[0].bits)) == line_dedup.CONTAINER // 8


def test_string_ids(spark):
    data = [("b", "the very same line\nx"), ("a", "The very same line"), ("c", "the very same line\nthe very same line")]
    out = line_dedup.line_counts(spark.createDataFrame(data, "doc_id string, text string"))
    assert rows(out, LINES[:3]) == Counter([("a", 1, 0), ("b", 2, 1), ("c", 2, 2)])


def test_audit_of_documents(spark, documents):
    assert rows(Q.op13_source_audit(spark, SF), AUDIT) == Counter(brute.audit(documents))


@pytest.mark.parametrize("least, block", [(10, 512), (1, 512), (1, 3), (2, 1)])
def test_hard_audit(hard, least, block, monkeypatch):
    monkeypatch.setattr(source_audit.kept_terms, "__defaults__", (10, block))
    assert rows(source_audit.audit(hard, least_documents=least), AUDIT) == Counter(brute.audit(HARD, least))


def test_audit_of_random_counts(spark):
    """Many levels, sources without some blocks, a source without terms, chunks of one row."""
    rng = np.random.default_rng(2)
    words = [f"{a}{b}é" for a in "abcdefghij" for b in "klmnopqrst"]
    data = [(i, " ".join(rng.choice(words[:5 + 19 * (i % 6)], 40)), "x" if i % 5 else None, f"s{i % 6}") for i in range(240)]
    data += [(900, "1 2 3", "x", "numbers"), (901, None, "none", "s1"), (902, "", "none", "s2"), (903, "once", "alone", None)]
    assert rows(source_audit.audit(spark.createDataFrame(data, SCHEMA)), AUDIT) == Counter(brute.audit(data))


def test_counts_that_are_sent_early(monkeypatch):
    import pyarrow as pa
    texts = [f"word{chr(97 + i % 20)} common" for i in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 100), pa.array([f"s{i % 3}" for i in range(100)]), pa.array(texts)], names=["l", "s", "t"])

    def total():
        out = Counter()
        for b in source_audit._counts(iter([batch])):
            for lang, source, term, n, df in zip(*(c.to_pylist() for c in b.columns)):
                out[lang, source, term, "n"] += n
                out[lang, source, term, "df"] += df
        return +out

    whole = total()
    monkeypatch.setattr(source_audit, "HELD", 3)
    assert total() == whole and whole["en", "s0", "common", "df"] == 34


def test_big_joint_cells_in_chunks(monkeypatch):
    rng = np.random.default_rng(9)
    counts = [rng.integers(0, 12, 100) for _ in range(4)]

    def levels(c):
        kinds = sorted(set(c.tolist()) - {0})
        bits = [np.packbits(np.append(c == k, np.zeros(28, dtype=bool)), bitorder="little").tobytes() for k in kinds]
        return source_audit._Levels(int(c.sum()), 100, kinds, bits, 2)

    def p(c):
        return [1 + 10**9 * (int(x) + 2) // (int(c.sum()) + 200) for x in c]

    want = [sum((a - b) ** 2 // (a + b) for a, b in zip(p(counts[0]), p(c))) for c in counts[1:]]
    for words in (1 << 20, 1):
        monkeypatch.setattr(source_audit, "WORDS_AT_ONCE", words)
        assert source_audit._joint(levels(counts[0]), [levels(c) for c in counts[1:]], 100).tolist() == want


@pytest.mark.parametrize("operator", [token_alignment.align_tokens, line_dedup.line_counts, line_dedup.deduplicated, line_dedup.keep_bitmaps, source_audit.audit])
def test_empty_table(nothing, operator):
    assert operator(nothing).collect() == []


def test_bytes_of_ids_give_the_text():
    encode = bpe.encoder(*bpe.default_files())
    table = encode.token_bytes()
    for text in (" a\xa0b \u3000 \U0001f600<|endoftext|>", " \x00\x7f\r\n", "é" * 50):
        assert b"".join(map(table.__getitem__, encode.plain(text))) == text.encode()
