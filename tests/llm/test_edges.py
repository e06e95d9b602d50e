"""Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch.llm import (bpe, components, exact_dedup, fair_mix, mil_quality, ngram_join, packing, pii_disclosure,
                          quality_divergence, secret_ownership, token_counts, token_files)
from tests.llm import brute
from tests.llm.conftest import HARD


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_quality(hard):
    out = quality_divergence.quality_rules(hard)
    assert rows(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == Counter(brute.quality(HARD))
    kept = out.where("kept").count()
    passing = quality_divergence.passing(hard)
    assert passing.columns == hard.columns and passing.count() == kept


def test_quality_of_unlisted_language_is_not_compared(spark):
    text = " ".join(f"W{i}##" for i in range(300))
    out = quality_divergence.quality_rules(spark.createDataFrame([(1, text, "xx"), (2, text, None)], "doc_id long, text string, lang string"))
    assert rows(out, "char_distance", "word_distance", "kept") == Counter({(None, None, True): 2})


def test_distance(spark):
    from pyspark.sql import functions as F
    a = F.array(*(F.lit(x).cast("long") for x in (3, 0, 1)))
    b = F.array(*(F.lit(x).cast("long") for x in (0, 5, 0)))
    zero = F.array(*(F.lit(x).cast("long") for x in (0, 0, 0)))
    got = spark.range(1).select(quality_divergence.distance(a, a), quality_divergence.distance(a, b), quality_divergence.distance(a, zero)).first()
    assert tuple(got) == (0.0, 1.0, None)


def test_personal_data(hard):
    out = pii_disclosure.personal_data(hard)
    assert rows(out, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == Counter(brute.personal(HARD))
    spans = {r.doc_id: r.spans for r in out.where("doc_id = 14").collect()}
    assert spans[14].startswith("email:5:12,")


def test_emails_next_to_each_other():
    for text in ("a@b@c.d", "a@b.c@d.e", "@x.y", "a@@b.c", "a@b.c.d@e.f g@h", "é@b.c", "a..b@c-d.e-f..g", "x@1.2.3.4"):
        want = brute.personal([(0, text)])[0]
        spans = pii_disclosure.base_spans(text)
        assert brute.span_digest([(s, k, pii_disclosure.KINDS[k], e) for s, k, e in spans]) == want[5], text


def test_disclosing_terms(spark):
    fill = [f"the report number{chr(97 + i % 26)}{chr(97 + i // 26)} of today was quite short" for i in range(200)]
    close = [f"{a} call Zebulon at +1 555 010 {x} {b}" for x, a, b in [("9999", "please", "or write"), ("9999", "do", "at once"), ("9999", "never", "after noon")]]
    docs = spark.createDataFrame(list(enumerate(fill + close + [close[0]])), "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii_disclosure.personal_data(docs).collect()}
    at = close[0].index("Zebulon")
    assert all("remove" in out[200 + i] for i in range(4)) and f"remove:{at}:{at + 7}" in out[200]
    assert all(out[i] == "" for i in range(200))
    clean = {r.doc_id: r.text for r in pii_disclosure.sanitised(docs).collect()}
    assert "Zebulon" not in clean[200] and "555" not in clean[200] and "please" in clean[200] and clean[5] == fill[5]


def test_copies_of_one_wording_disclose_nothing(spark):
    docs = spark.createDataFrame([(i, "ask Zebulon at +1 555 010 9999 today") for i in range(9)] + [(i, f"other {i}") for i in range(9, 60)], "doc_id long, text string")
    assert not pii_disclosure.personal_data(docs).where("spans rlike 'remove|general'").count()


def test_secrets(hard):
    assert rows(secret_ownership.scan_secrets(hard), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == Counter(brute.secrets(HARD))


def test_owned_and_copied_secrets(spark):
    example, own = "token = Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8", "secret: Zz9Yy8Xx7Ww6Vv5Uu4Tt3Ss2"
    data = [(i, f"x {example} y", "en", f"s{i % 4}") for i in range(8)] + [(8, own, "en", "s0"), (9, own, "fr", "s0"), (10, own, "en", None), (11, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in secret_ownership.scan_secrets(docs).collect()}
    assert all(out[i].n_copied == 1 and out[i].n_live == 0 and "opaque" not in out[i].spans for i in range(8))
    assert all(out[i].n_copied == 0 and out[i].n_live == 2 for i in (8, 9, 10)) and out[11].spans == ""      # one text, mirrored: one holder
    two = docs.where("doc_id in (8, 9)").union(spark.createDataFrame([(12, "see " + own, "en", "s1")], docs.schema))
    assert all(r.n_copied == 0 and r.n_live == 0 for r in secret_ownership.scan_secrets(two).collect())      # two holders: neither
    alone = {r.doc_id: r for r in secret_ownership.scan_secrets(docs.where("doc_id in (8, 9)")).collect()}
    assert all(r.n_live == 2 and "opaque:8:" in r.spans for r in alone.values())


def test_secret_rules_and_their_sql(spark, tmp_path):
    """Values around every limit: owners, repositories, texts, holders."""
    import duckdb
    from tabwatch.llm import queries
    value = lambda i: f"Ab{i:02d}Cd2Ef3Gh4Ij5Kl6Mn7Op8"
    data, add = [], lambda *row: data.append((len(data), *row))
    for n in range(1, 13):
        for i in range(n):
            add(f"text {i} token = {value(n)}", "en", "one")                                              # n texts of one owner
            add(f"same token = {value(20 + n)}", "en", f"s{i}")                                           # a text of n owners
            add(f"same token = {value(40 + n)}", f"l{i}", "one")                                          # a text of n repositories
            add(f"own {i % 2} token = {value(60 + n)}", None, [None, "x", "y"][i % 3])                    # nulls, two texts
    add(None, None, None)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(3)
    docs.write.parquet(str(tmp_path / "d"))
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
        want = c.sql(queries.ORACLES["op3_secret_ownership"])
        columns, want = want.columns, Counter(want.fetchall())
    assert rows(secret_ownership.scan_secrets(docs), *columns) == want
    assert len({w[-2:] for w in want}) >= 3


def test_mix(hard):
    out = fair_mix.mix_shares(hard)
    size, total = Counter(), Counter()
    for doc, text, _, source in HARD:
        size[doc, len(brute.words(text))] += 1
        total[source] += len(brute.words(text))
    want = brute.targets(total)
    got = rows(out, "doc_id", "size", "source_size", "target", "taken")
    assert Counter({k: n for k, n in size.items()}) == sum((Counter({k[:2]: n}) for k, n in got.items()), Counter())
    assert sum(k[4] * n for k, n in got.items()) == pytest.approx(sum(want.values()), abs=len(want))
    assert all(0 <= k[4] <= 2 * k[1] for k in got)


def test_targets_of_many_sources(spark):
    """More sources than a task may order, capped and not, one null, some empty."""
    rng = np.random.default_rng(11)
    total = Counter({f"s{i}": int(x) for i, x in enumerate(rng.pareto(0.7, 400) * 10)})
    total[None] = 50
    sizes = spark.createDataFrame([(s, n) for s, n in total.items()], "source string, size long").repartition(4)
    plain = fair_mix.prefix_sums
    fair_mix.prefix_sums = lambda df, order, sums: plain(df, order, sums, 40)
    try:
        got = {r.source: r.target for r in fair_mix.source_targets(sizes).collect()}
    finally:
        fair_mix.prefix_sums = plain
    want = brute.targets(total)
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for s in want)


def test_mixed_rows_add_up_to_the_shares(hard):
    out = fair_mix.mixed(hard, chars_col="n_chars")
    assert out.columns == hard.columns
    taken = sum(r.taken for r in fair_mix.mix_shares(hard).collect())
    assert sum(len(brute.words(r.text)) for r in out.collect()) == taken
    texts = {t for _, t, *_ in HARD}
    assert sum(r.text not in texts for r in out.collect()) <= len({r[3] for r in HARD})


def test_mix_deals_one_source_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fair_mix, "BUCKET_ROWS", 7)
    docs = spark.range(500).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 9 as int)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 2)) as source")
    out = fair_mix.mix_shares(docs).collect()
    total = Counter()
    source = {i: "hot" if i % 3 == 0 else f"s{i % 2}" for i in range(500)}
    taken = Counter()
    for r in out:
        total[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    want = brute.targets(total)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_tokens(hard):
    import public_tokenizers
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((d, len((t or "").encode()), len(model.encode(t or ""))) for d, t, *_ in HARD)
    assert rows(token_counts.count_tokens(hard), "doc_id", "n_bytes", "n_tokens") == want
    assert rows(token_counts.count_tokens(hard, table=1), "doc_id", "n_bytes", "n_tokens") == want


ALPHABET = ["a", "é", "z", "Word", "1", " ", "  ", "\n", "\t", "▁", ".", "'s", "　", "\xa0", "\x1c", "\U0001f600", "<|endoftext|>", "<s>", "\x00", "'", "-"]


def test_encoders_agree_with_the_libraries():
    import public_tokenizers
    import sentencepiece
    whole = brute.bpe()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ours, lengths = bpe.encoder(*bpe.default_files()), token_counts.Lengths(public_tokenizers.path("piece_bpe_32k.model"), {})
    rng = np.random.default_rng(5)
    for _ in range(4000):
        text = "".join(rng.choice(ALPHABET, rng.integers(0, 14)))
        assert np.frombuffer(ours.ids(text), dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
        assert lengths.count(text) == len(model.encode(text)), repr(text)


def test_similar(hard):
    out = rows(ngram_join.similar_documents(hard), "doc_id", "n_shingles", "component_id")
    assert out == Counter(brute.similar(HARD))
    one = ngram_join.keep_one_of_each(hard)
    want = brute.similar(HARD, 5, 80)
    assert one.columns == hard.columns
    both_of_16 = 1        # two texts share this id and are components of their own
    assert one.count() == len({c for _, n, c in want if n}) + both_of_16 + sum(n == 0 for _, n, _ in want)


@pytest.mark.parametrize("heavy", [0.005, 0.3])
def test_similar_in_a_crowd_of_near_copies(spark, heavy, monkeypatch):
    """Many variants of one text, chains of variants, and a passage that all share."""
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    monkeypatch.setattr(ngram_join, "HEAVY_IN_BATCH", 4)
    rng = np.random.default_rng(11)
    base, passage = [f"b{i}" for i in range(70)], [f"p{i}" for i in range(50)]
    data = []
    for i in range(160):
        w = list(base)
        for at in rng.integers(0, 70, rng.integers(0, 5)):
            w[at] = f"v{rng.integers(0, 40)}"
        data.append((i, " ".join(w)))
    w = [f"c{i}" for i in range(120)]
    for i in range(160, 200):
        w[rng.integers(0, 120)] = f"d{i}"
        data.append((i, " ".join(w)))
    data += [(i, " ".join([f"u{i}x{j}" for j in range(rng.integers(3, 60))] + passage)) for i in range(200, 260)]
    out = ngram_join.similar_documents(spark.createDataFrame(data, "doc_id long, text string").repartition(4))
    want = brute.similar(data)
    assert rows(out, "doc_id", "n_shingles", "component_id") == Counter(want)
    assert 3 < len({c for _, _, c in want}) < 200


def test_similar_over_thousands_of_fragments(spark, monkeypatch):
    """Most fragments hold a hundred n-grams; a set's parts stay five rows."""
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 300)) for _ in range(150)]
    data = list(enumerate(texts + [t + " and a tail" for t in texts[::3]] + ["x " + t for t in texts[::5]]))
    monkeypatch.setattr(ngram_join, "FRAGMENT", 20)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(ngram_join.similar_documents(docs), "doc_id", "n_shingles", "component_id") == Counter(brute.similar(data))


@pytest.mark.parametrize("percent", [50, 80, 85, 99])
def test_heads_of_similar_sets_share_what_they_must(percent):
    """Heads alone put every set with a similar one on the list, heavy n-grams or not,
    and leave out most others; what they send does not grow with the fragments' number."""
    import pyarrow as pa
    rng = np.random.default_rng(percent)
    heavy = np.unique(rng.integers(0, 2**64, 40, dtype=np.uint64))
    sets, paired = [], []
    for n in (1, 2, 3, 7, 20, 90, 400):
        for kind in range(12):
            one = np.unique(np.concatenate([rng.integers(0, 2**64, n, dtype=np.uint64), heavy[:kind] if kind < 5 else heavy[:0]]))
            drop = rng.integers(0, len(one) * (100 - percent) // 100 + 1)
            paired += [len(sets), len(sets) + 1]
            sets += [one, np.sort(rng.choice(one, len(one) - drop, replace=False))]
    sets.append(heavy)
    alone = len(sets)
    sets += [np.unique(rng.integers(0, 2**64, 200, dtype=np.uint64)) for _ in range(50)]
    nodes = list(range(1, len(sets) + 1))
    for fragments in (3, 1000):
        dealt = pa.Table.from_batches([b for at in range(0, len(sets), 37) for b in ngram_join._deal_heads(nodes[at:at + 37], sets[at:at + 37], percent, fragments, heavy)])
        found = [ngram_join._heads_shared(5)(dealt.filter(pa.compute.equal(dealt["f"], f))) for f in sorted(set(dealt["f"].to_pylist()))]
        packets = pa.concat_tables(found)
        left = {x for b in set(packets["b"].to_pylist()) for x in ngram_join._left(packets.filter(pa.compute.equal(packets["b"], b)))["node"].to_pylist()}
        assert {i + 1 for i in paired} <= left and not left & set(nodes[alone:])
        sent = sum(len(x) for x in dealt["ids"].to_pylist())
        assert sent <= sum(4 * (len(s) * (100 - percent + ngram_join.AHEAD) // 100 + 2) for s in sets)


def test_whole_sets_are_sent_of_listed_documents_alone(spark, monkeypatch):
    """Documents that share nothing with others are out before whole sets are sent."""
    sent, plain = [], ngram_join._number_of_fragments
    monkeypatch.setattr(ngram_join, "_number_of_fragments", lambda grams: sent.append(grams) or plain(grams))
    data = [(i, " ".join(f"w{i}x{j}" for j in range(200))) for i in range(80)]
    data += [(100, data[3][1] + " more"), (101, data[3][1] + " and more"), (102, data[4][1].upper())]
    out = ngram_join.similar_documents(spark.createDataFrame(data, "doc_id long, text string"))
    assert rows(out, "doc_id", "n_shingles", "component_id") == Counter(brute.similar(data))
    assert sent[1] == 197 + 198 + 199


def test_any_fragment_number():
    """A fragment beyond 2^15 gives the n-grams' whole hashes."""
    import pyarrow as pa
    grams = [np.sort(np.array(x, dtype=np.uint64)) for x in ([5, 2**63 + 7, 2**64 - 1], [2**63 + 7, 9], [2**64 - 1])]
    column = lambda kind, values: pa.array([np.array(values, dtype=kind).tobytes()], pa.binary())
    nothing = np.empty(0, dtype=np.uint64)
    for f in (40_000, 2**40):
        table = pa.table({"f": pa.array([f], pa.int64()), "nodes": column(np.int64, [1, 2, 3]), "sizes": column(np.int32, [3, 2, 1]),
                          "lengths": column(np.int32, [3, 2, 1]), "ids": column(np.uint64, np.concatenate(grams))})
        packets = ngram_join._shared(nothing, nothing.astype(np.int32), 2)(table)
        assert packets.column("b").to_pylist() == [0, 1] and packets.column("f").to_pylist() == [f, f]
        sets = {r["node"]: r for r in ngram_join._gathered(50)(packets).to_pylist()}
        assert {k: (r["n"], r["held"]) for k, r in sets.items()} == {1: (3, 2), 2: (2, 1), 3: (1, 1)}
        assert {k: [sorted(x % 2**64 for x in p["ids"]) for p in r["parts"]] for k, r in sets.items()} == {1: [[2**63 + 7, 2**64 - 1]], 2: [[2**63 + 7]], 3: [[2**64 - 1]]}
        assert all(p["counts"] == [2] * len(p["ids"]) and p["part"] == f % ngram_join.PARTS for r in sets.values() for p in r["parts"])
        assert ngram_join._gathered(100)(packets).column("node").to_pylist() == [3]


def test_parts_of_a_set_over_many_fragments():
    """Segments of many fragments and the heavy part come together, five parts at most."""
    import pyarrow as pa
    heavy = np.array([3, 2**63 + 1], dtype=np.uint64)
    rng = np.random.default_rng(7)
    want, tables = {node: set() for node in (-5, 8, 11)}, []
    for f in [*range(30), -2]:
        rows, ids = [], []
        for node in want:
            grams = heavy if f < 0 else np.unique(rng.integers(f * 1000, f * 1000 + 9, 6).astype(np.uint64))
            rows.append((node, len(grams)))
            ids.append(grams)
            want[node] |= {int(g) for g in grams}
        packed = lambda kind, values: pa.array([np.array(values, dtype=kind).tobytes()], pa.binary())
        table = pa.table({"f": pa.array([f], pa.int64()), "nodes": packed(np.int64, [r[0] for r in rows]), "sizes": packed(np.int32, [200] * 3),
                          "lengths": packed(np.int32, [r[1] for r in rows]), "ids": packed(np.uint64, np.concatenate(ids))})
        tables.append(ngram_join._shared(heavy, np.array([7, 9], dtype=np.int32), 1)(table))
    seen = Counter(g for grams in want.values() for g in grams)
    got = {r["node"]: r for r in ngram_join._gathered(1)(pa.concat_tables(tables)).to_pylist()}
    for node, grams in want.items():
        parts = got[node]["parts"]
        assert sorted(p["part"] for p in parts) == [0, 1, 2, 3, 4]
        assert sorted(g % 2**64 for p in parts for g in p["ids"]) == sorted(g for g in grams if seen[g] > 1)
        assert got[node]["held"] == sum(len(p["ids"]) for p in parts)
        assert all(c == (7 if g == 3 else 9 if p["part"] == 4 else seen[g]) for p in parts for g, c in zip(p["ids"], p["counts"]))


@pytest.mark.parametrize("percent", [50, 80, 85, 99])
def test_similar_sizes_are_in_neighbouring_bands(spark, percent):
    sizes = spark.range(1, 3000).withColumn("m", F.ceil(F.col("id") * percent / 100))
    far = sizes.where(F.abs(ngram_join._size_band("id", percent) - ngram_join._size_band("m", percent)) > 1)
    assert far.count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000)]
    got = dict(components.components(spark.createDataFrame(pairs, "u long, v long")).collect())
    parent = {x: x for p in pairs if p[0] != p[1] for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            parent[hi] = lo
    assert got == {x: find(x) for x in parent}


def test_exact(hard):
    want = Counter(brute.exact(HARD))
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(exact_dedup.exact_duplicates(hard), *columns) == want
    assert rows(exact_dedup.exact_duplicates(hard, huge_chars=1000), *columns) == want      # long texts as chunk rows
    one = exact_dedup.keep_one_of_each(hard)
    assert one.columns == hard.columns
    assert rows(one, "doc_id") == sum((Counter({(k[0],): n}) for k, n in want.items() if k[3]), Counter())


def test_fingerprints_compose():
    data = bytes(np.random.default_rng(1).integers(0, 256, 20_000, dtype=np.uint8))
    for cut in (0, 1, 4095, 4096, 4097, 12_345, 20_000):
        left, right = data[:cut], data[cut:]
        assert exact_dedup.compose(exact_dedup.fingerprint(left), exact_dedup.fingerprint(right), len(right)) == exact_dedup.fingerprint(data)
    p = exact_dedup.PRIMES[0]
    assert exact_dedup.fingerprint(b"ab")[0] == (98 * exact_dedup.BASE + 99) % p


def test_equal_fingerprints_of_different_texts_are_told_apart(spark, monkeypatch):
    """With every fingerprint the same, the chunk comparison must divide the classes."""
    docs = spark.createDataFrame([(1, "ab"), (2, "a b"), (3, "cd"), (4, "xyz")], "doc_id long, text string")
    rows_ = exact_dedup.digests(docs).collect()
    same = spark.createDataFrame([(r.doc_id, r.n_chars, 7, r.n_bytes, r.text_sha256) for r in rows_], "doc_id long, n_chars long, fp long, n_bytes long, text_sha256 string")
    monkeypatch.setattr(exact_dedup, "digests", lambda *a: same)
    monkeypatch.setattr(exact_dedup, "collisions", lambda *a: spark.createDataFrame([(7, 2)], "fp long, n_bytes long"))
    assert rows(exact_dedup.exact_duplicates(docs), "doc_id", "keep_id", "group_size", "kept") == Counter(
        [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True)])


@pytest.mark.parametrize("kind, ids", [("string", ["b", "a", None, "c"]), ("long", [5, -2**63, None, 2**63 - 1])])
def test_exact_ids_of_any_order(spark, kind, ids):
    docs = spark.createDataFrame(list(zip(ids, ["x y", "x\ty", "x\ny", "x  y"])), f"doc_id {kind}, text string")
    out = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert out == {i: (ids[3], i == ids[3]) for i in ids}
    same = docs.where("text <> 'x  y'")
    assert [r.doc_id for r in exact_dedup.keep_one_of_each(same).collect()] == [ids[1]]
    assert {r.keep_id for r in exact_dedup.exact_duplicates(same).collect()} == {ids[1]}


def test_differing_chunks_divide_a_class(spark, monkeypatch):
    """Rows that claim one fingerprint and length: only the comparison tells them apart."""
    long_ = "a" * (exact_dedup.COMPARE + 5)
    docs = spark.createDataFrame([(1, long_ + "b"), (2, long_ + " b"), (3, long_ + "c")], "doc_id long, text string")
    n_bytes = exact_dedup.COMPARE + 6

    def one_mark(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x] * batch.num_rows, pa.int64()) for x in (7, n_bytes)], names=["fp", "n_bytes"])

    monkeypatch.setattr(exact_dedup, "_marks", one_mark)
    assert rows(exact_dedup.keep_one_of_each(docs), "doc_id") == Counter([(2,), (3,)])


def test_chunks_are_compared_to_their_last_byte(spark):
    """Of classes that claim to be one, those whose texts differ at a chunk's border."""
    size = exact_dedup.COMPARE
    texts = {0: ["", None, " \t"], 1: ["a", " a"], size - 1: ["é" * (size // 2 - 1) + "a"] * 2, size: ["é" * (size // 2), "é \n" * (size // 2)],
             size + 1: ["é" * (size // 2) + "a", "é" * (size // 2) + " a"], 2 * size: ["b" * 2 * size, " " + "b" * 2 * size]}
    docs = spark.createDataFrame([(t,) for same in texts.values() for t in same], "text string")
    marks = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(exact_dedup._marks, "fp long, n_bytes long").distinct().cache()
    assert {r.n_bytes for r in marks.collect()} == set(texts) and exact_dedup.collisions(docs, marks).count() == 0

    plain, claims = exact_dedup._marks, spark.createDataFrame([(n, n) for n in texts], "fp long, n_bytes long")

    def claimed(batches):
        for batch in plain(batches):
            yield batch.set_column(0, "fp", batch.column(1))

    for at in (0, size - 1, size, 2 * size - 1):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(exact_dedup, "_marks", claimed)
            changed = docs.union(spark.createDataFrame([("b" * at + "c" + "b" * (2 * size - at - 1),)], "text string"))
            assert rows(exact_dedup.collisions(changed, claims), "fp", "n_bytes") == Counter([(2 * size, 2 * size)])


def _python_steps(plan):
    """Of a physical plan: the Python steps that a task of its last stage has, and the most of any task."""
    kids = [_python_steps(plan.children().apply(i)) for i in range(plan.children().size())]
    own, most = [k[0] for k in kids], max([k[1] for k in kids], default=0)
    name = plan.nodeName()
    if "Exchange" in name:
        return 0, max([most, *own])
    here = (max if name == "Union" else sum)(own or [0]) + (name in ("MapInArrow", "PythonMapInArrow", "FlatMapGroupsInArrow"))
    return here, max(most, here)


@pytest.mark.parametrize("operator", [exact_dedup.keep_one_of_each, exact_dedup.exact_duplicates, ngram_join.keep_one_of_each, ngram_join.similar_documents])
def test_a_task_has_one_python_step(spark, documents, monkeypatch, operator):
    """Each further one is a Python worker more, which stays and is used by the steps after it."""
    seen = []

    def steps(df):
        seen.append(_python_steps(df._jdf.queryExecution().executedPlan())[1])
        return df

    for module in (exact_dedup, ngram_join):
        monkeypatch.setattr(module, "stored", lambda df, name, f=module.stored: f(steps(df), name))
    monkeypatch.setattr(exact_dedup, "with_row_key", lambda df, name, f=exact_dedup.with_row_key: f(steps(df), name))
    docs = spark.createDataFrame(documents[:60] + documents[:20], "doc_id long, text string, lang string, source string")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        steps(operator(docs)).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert max(seen) == 1


def test_huge_texts_are_cut_in_one_pass(spark):
    import time
    huge = spark.range(2, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("twenty characters é\n"), 2_000_000).alias("text"))
    start = time.monotonic()
    out = exact_dedup.exact_duplicates(huge).collect()
    assert time.monotonic() - start < 30
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in out} == {(0, 0, 2, True), (1, 0, 2, False)}


def test_packing(hard):
    tokenizer = brute.bpe()
    ids = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for d, t, *_ in HARD]
    out = packing.packed(hard)
    brute.check_packing(list(map(tuple, out.collect())), ids)
    small = packing.packed(hard, window=64)
    brute.check_packing(list(map(tuple, small.collect())), ids, 64)


def test_sum_of_squares_places_by_least_gain():
    rng = np.random.default_rng(8)
    packer = packing.LevelPacker(16, 0)
    for _ in range(300):
        n = int(rng.integers(1, 16))
        before = packer.counts.copy()

        def squares(level):
            after = before.copy()
            after[level] -= level > 0
            after[level + n] += level + n < 16
            return int((after[1:16] ** 2).sum())

        best = min(squares(g) for g in range(0, 17 - n) if g == 0 or before[g])
        packer.place((0, 0, bytes(4 * n), n))
        assert int((packer.counts[1:16] ** 2).sum()) == best


@pytest.mark.parametrize("most", [1, 8, 32])
def test_open_windows_stay_under_their_bound(most):
    """At the bound an item goes where the squares grow least, and is cut rather than opening a window."""
    rng = np.random.default_rng(most)
    packer, tokens = packing.LevelPacker(64, 0, most), 0
    for doc in range(600):
        n = int(rng.integers(1, 64))
        before, squares = packer.counts.copy(), int((packer.counts[1:64] ** 2).sum())
        packer.place((doc, 0, bytes(4 * n), n))
        tokens += n
        assert packer.counts.sum() <= most
        if before.sum() >= most:
            best = []
            for g in np.flatnonzero(before):
                after = before.copy()
                after[g] -= 1
                if g + n != 64:
                    after[(g + n) % 64] += 1
                best.append(int((after[1:64] ** 2).sum()))
            assert int((packer.counts[1:64] ** 2).sum()) == min(best)
    closed = sum(p[2] for p in packer.out)
    assert closed >= tokens - most * 64 and all(s == 64 for s in Counter(p[5] for p in packer.out for _ in range(p[2])).values())
    packer.finish()
    assert sum(p[2] for p in packer.out) == tokens


def test_levels_place_most_tokens_of_a_small_partition(documents):
    """320 documents a task: most of what is left beside full windows is in windows closed by placement."""
    encode = bpe.encoder(*bpe.default_files())
    shares = []
    for at in range(0, 960, 320):
        packer = packing.LevelPacker(packing.WINDOW, 0, packing.OPEN)
        rest = 0
        for doc, text, *_ in documents[at:at + 320]:
            ids = encode.ids(text) + bytes(4)
            rest += len(ids) // 4 % packing.WINDOW
            packer.add(doc, ids)
        left = int((packer.counts * np.arange(packing.WINDOW + 1)).sum())
        shares.append(1 - left / rest)
    assert min(shares) >= 0.7, shares


def test_token_files(spark, hard, tmp_path):
    tokenizer = brute.bpe()
    path = str(tmp_path / "tokens")
    out = token_files.round_trip(hard, path=path)
    have = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in out.collect()))
    at = 0
    for start, _, n, _ in have:
        assert start == at
        at += n
    order = [(d is not None, d or 0) for _, d, *_ in have]
    assert order == sorted(order)
    ids = Counter((d, brute.crc(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for d, t, *_ in HARD)
    assert Counter((d, c) for _, d, _, c in have) == ids
    assert sorted(r.start for r in token_files.read_index(spark, path).collect()) == [h[0] for h in have]
    some = token_files.read_tokens(spark, path, 7, 9)
    assert sorted(r.doc_id for r in some.collect()) == [7, 8, 9]
    plan = token_files.read_index(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan and "n_tokens:bigint" in plan
    import glob
    import pyarrow.parquet as pq
    meta = [pq.ParquetFile(f).metadata for f in glob.glob(path + "/*.parquet")]
    columns = [g.column(i) for m in meta for g in (m.row_group(j) for j in range(m.num_row_groups)) for i in range(g.num_columns)]
    assert all(c.has_offset_index for c in columns)
    assert any("DICTIONARY" in str(c.encodings) for c in columns if c.path_in_schema.startswith("tokens"))
    assert all("DELTA_BINARY_PACKED" in str(c.encodings) for c in columns if c.path_in_schema == "file_start")


def test_scores(spark, hard):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(1, 19)] + [(None, 1, "x"), (3, None, "x"), (999, 1, "x")], "doc_id long, quality int, text string")
    model = mil_quality.train(hard, labels)
    out = mil_quality.score(hard, model).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in HARD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    none = mil_quality.train(hard, labels.where("false"))
    assert {r.score for r in mil_quality.score(hard, none).collect()} == {0.5}


def test_attention_gradient():
    """The fit's first step follows the numeric gradient of the loss."""
    rng = np.random.default_rng(4)
    bags = [rng.random((int(n), mil_quality.N_FEATURES)).astype(np.float32) for n in rng.integers(1, 5, 12)]
    labels = (rng.random(12) > 0.5).astype(float)
    model = mil_quality.AttentionModel(rng)

    def loss():
        y = np.clip(model.scores(bags), 1e-12, 1 - 1e-12)
        return -(labels * np.log(y) + (1 - labels) * np.log(1 - y)).mean()

    start = loss()
    model.fit(bags, labels)
    assert loss() < 0.2 * start


def features(text):
    """mil_quality.encode by plain loops over passages, words and bytes."""
    import math
    import re
    import xxhash
    marks, n_buckets = b".,;:'\"!?()-", mil_quality.BUCKETS
    kinds = (re.compile(rb"[a-z]"), re.compile(rb"[A-Z]"), re.compile(rb"[0-9]"), re.compile(rb"[ \t-\r]"), re.compile(rb"[.,;:'\"!?()-]"),
             re.compile(rb"[^a-zA-Z0-9 \t-\r.,;:'\"!?()\x80-\xff-]"), re.compile(rb"[\x80-\xff]"))
    data = (text or "").encode()
    found = list(re.finditer(rb"[^ \t-\r]+", data))
    if not found:
        return np.zeros((1, mil_quality.N_FEATURES))
    out, step = [], mil_quality.PASSAGE
    for i in range(0, len(found), step):
        words = [m.group() for m in found[i:i + step]]
        part = data[found[i].start() if i else 0:found[i + step].start() if i + step < len(found) else len(data)]
        mean = lambda values: sum(values) / len(words)  # noqa: B023, E731
        shapes = [mean(w.isupper() and len(w) > 1 for w in words), mean(w[:1].isupper() for w in words), mean(w[-1:] in b".,;:!?" for w in words),
                  mean(not re.search(rb"[a-zA-Z\x80-\xff]", w) for w in words), mean(bool(kinds[5].search(w)) for w in words),
                  mean(len(w.strip(marks)) > 15 for w in words)]
        buckets = Counter(xxhash.xxh64_intdigest(w) % n_buckets for w in words)
        out.append([len(k.findall(part)) / len(part) for k in kinds] + shapes + [buckets[b] / len(words) for b in range(n_buckets)]
                   + [mean(a == b for a, b in zip(words, words[1:])), len(set(words)) / len(words), mean(map(len, words)) / 10,
                      math.log(len(words)), part.count(b"\n") / len(words)])
    return np.array(out)


def test_passages_equal_plain_loops():
    import random
    r = random.Random(6)
    texts = [row[1] for row in HARD] + ["a", " a", "a ", "\n\na\n", "-" * 40, "(" + "x" * 15 + ")", "(" + "x" * 16 + ").", "AB Ab A 1 $ é. É"]
    texts += [" ".join(r.choice(["AB", "ab.", "\n", "(" + "x" * r.randint(1, 20) + ").", f"w{r.randint(0, 90)}", "é$"]) for _ in range(n))
              for n in (1, 127, 128, 129, 256, 257, 1000)]
    texts += ["".join(r.choice("aZ09 \t\n\x0b\x0c\r.,-'(!$\x00\x1c\x7f\xa0é😀") for _ in range(n)) for n in (3, 30, 900, 9000) for _ in range(50)]
    for text in texts:
        have, want = mil_quality.encode(text), features(text)
        assert have.shape == want.shape and np.allclose(have, want, rtol=1e-6, atol=0)


def test_new_words_take_no_python_calls():
    """A text of words never seen before: calls in Python grow with neither words nor passages."""
    import sys
    calls = Counter()
    mil_quality.encode("warm up")
    for n in (1_000, 20_000):
        text = " ".join(f"{n}x{i}" for i in range(n))
        sys.setprofile(lambda frame, event, arg: calls.update([n]) if event == "call" else None)  # noqa: B023
        try:
            mil_quality.encode(text)
        finally:
            sys.setprofile(None)
    assert 0 < calls[20_000] <= calls[1_000] + 20 < 500


@pytest.mark.parametrize("operator", [
    quality_divergence.quality_rules, quality_divergence.passing, pii_disclosure.personal_data, secret_ownership.scan_secrets,
    fair_mix.mix_shares, fair_mix.mixed, token_counts.count_tokens, ngram_join.similar_documents, ngram_join.keep_one_of_each,
    exact_dedup.exact_duplicates, exact_dedup.keep_one_of_each, packing.packed, token_files.round_trip,
    lambda df: mil_quality.score(df, mil_quality.AttentionModel(np.random.default_rng(0)))])
def test_empty_table(nothing, operator):
    assert operator(nothing).collect() == []


def test_full_caches_change_no_result(monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(token_counts, "CACHED", 6)
    lengths = token_counts.Lengths(public_tokenizers.path("piece_bpe_32k.model"), {})
    text = " ".join(f"w{i * i % 11}" for i in range(80))
    for _ in range(2):
        assert lengths.count(text) == len(lengths.model.encode(text))
    assert len(lengths) + len(lengths.before) <= 6


@pytest.mark.parametrize("run", [" " * 30_000, "\n" * 1_200_000, " \t" * 200_000, "\xa0" * 100_000])
def test_long_runs_of_white_space_are_encoded(run):
    text = f"a{run}b <|endoftext|>{run}"
    ids = bpe.encoder(*bpe.default_files()).ids(text)
    assert np.frombuffer(ids, dtype="<u4").tolist() == brute.bpe().encode(text, add_special_tokens=False).ids
