"""Cases in which an operator once did less than its whole job."""

import pytest

from tabwatch.llm import mil_quality, pii_disclosure, quality_divergence, secret_ownership


def fill(n):
    return [f"the report number{chr(97 + i % 26)}{chr(97 + i // 26)} of today was quite short" for i in range(n)]


def test_terms_disclose_from_anywhere_in_the_document(spark):
    far = " of today was quite short" * 20
    letters = [f"Zebulon {a}.{far} Call +1 555 010 9999.{far}\n\nYours, Zebulon" for a in ("writes", "asks", "waits")]
    docs = spark.createDataFrame(list(enumerate(fill(200) + letters)), "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii_disclosure.personal_data(docs).collect()}
    assert all(out[i] == "" for i in range(200))
    for i, text in enumerate(letters):
        last = text.rindex("Zebulon")
        assert "remove:0:7," in out[200 + i] and f"remove:{last}:{last + 7}" in out[200 + i]
    clean = {r.doc_id: r.text for r in pii_disclosure.sanitised(docs).collect()}
    assert all("Zebulon" not in clean[200 + i] and "today was quite" in clean[200 + i] for i in range(3))


def test_shares_are_of_whole_documents(spark):
    """A term of all documents is in those of the entity too, and discloses nothing."""
    texts = fill(100) + [f"the report {a} of today: +1 555 010 9999" for a in ("one", "two", "three")]
    out = pii_disclosure.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).where("doc_id >= 100")
    assert not out.where("spans rlike 'remove|general'").count()


def test_form_letters_and_short_names_disclose(spark):
    """Word for word the same around the number, in different documents; a name of two letters."""
    same = " of today was quite short" * 20 + ". Ask Li or Zebulon or \u674e\u660e at +1 555 010 9999."
    texts = fill(200) + [f"the report {a}{same}" for a in ("one", "two", "three")]
    out = {r.doc_id: r.spans for r in pii_disclosure.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i in range(200, 203):
        for name in ("Li", "Zebulon", "\u674e\u660e"):
            at = texts[i].index(name)
            assert f"remove:{at}:{at + len(name)}" in out[i]
        assert f":{texts[i].index(' of today') + 1}:" not in out[i]
    assert all(out[i] == "" for i in range(200))


@pytest.mark.parametrize("lang", ["xx", None])
def test_quality_compares_characters_in_every_language(spark, lang):
    prose, odd = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)), " ".join(f"W{i}##" for i in range(300))
    docs = spark.createDataFrame([(i, prose, lang) for i in range(30)] + [(30, odd, lang), (31, prose, "en"), (32, odd, "yy")], "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in quality_divergence.quality_rules(docs).collect()}
    assert len(out) == 33 and all(out[i].kept and out[i].char_distance < 0.2 and out[i].word_distance is None for i in range(30))
    assert out[30].char_distance > quality_divergence.MAX_CHAR_DISTANCE and not out[30].kept and not out[30].base_failed
    assert out[32].char_distance is None and out[32].kept
    assert 30 not in {r.doc_id for r in quality_divergence.passing(docs).collect()}


def test_quality_sql_holds_for_every_language(spark, tmp_path):
    """Listed languages, one without a list, none, and a document alone in its language."""
    import duckdb
    import numpy as np
    from collections import Counter
    from tabwatch.llm import queries
    rng = np.random.default_rng(4)
    words = ["the", "of", "und", "der", "la", "que", "Word", "x1", "naïve", "#a", "été,", "(so)"]
    data = [(i, " ".join(rng.choice(words, int(rng.integers(1, 300)))) + "\n" * int(rng.integers(0, 3)), [None, "xx", "en", "de", "fr"][i % 5]) for i in range(90)]
    data += [(90, " ".join(f"W{i}##" for i in range(300)), "xx"), (91, " ".join(f"W{i}##" for i in range(300)), None), (92, " ".join(words * 30), "alone"), (93, None, "xx"), (94, "", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3)
    docs.write.parquet(str(tmp_path / "d"))
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
        rel = c.sql(queries.ORACLES["op1_distribution_divergence"])
        columns, want = rel.columns, rel.fetchall()
    near = lambda rows: Counter(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in rows)
    got = near(tuple(r) for r in quality_divergence.quality_rules(docs).select(*columns).collect())
    assert got == near(want)
    at = columns.index("char_distance")
    assert sum(w[at] is not None for w in want) == 92 and [w[at] for w in want if w[0] == 92] == [None]


def test_examples_of_one_source_are_copied(spark):
    example, own, wide = "token = Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8", "secret: Zz9Yy8Xx7Ww6Vv5Uu4Tt3Ss2", "secret: Qq1Ww2Ee3Rr4Tt5Yy6Uu7Ii8"
    data = [(i, f"page {i} {example} y", "en", "s0") for i in range(secret_ownership.EXAMPLE_TEXTS)]
    data += [(i, own, "en", "s0") for i in range(100, 120)]                                                # copies of one text
    data += [(200 + i, wide, f"l{i}", "s0") for i in range(secret_ownership.EXAMPLE_REPOS)]
    out = {r.doc_id: r for r in secret_ownership.scan_secrets(spark.createDataFrame(data, "doc_id long, text string, lang string, source string")).collect()}
    assert len(out) == len(data)
    for i, r in out.items():
        if 100 <= i < 200:
            assert r.n_live == 2 and r.n_copied == 0 and "opaque:8:" in r.spans
        else:
            assert r.n_live == 0 and r.n_copied == 1 and "opaque" not in r.spans


@pytest.fixture
def fitted(monkeypatch):
    """The bags that the model is fitted on."""
    seen = []
    monkeypatch.setattr(mil_quality.AttentionModel, "fit", lambda self, bags, labels: seen.extend(bags))
    return seen


def learned(n):
    """So many ids that are not held out."""
    import zlib
    return [i for i in range(10 * n) if zlib.crc32(str(i).encode()) % 3 != 1][:n]


def test_repeated_id_is_fitted_once(spark, fitted):
    one, two = learned(2)
    docs = spark.createDataFrame([(one, f"text {i}") for i in range(50)] + [(two, "other text")], "doc_id long, text string").repartition(4)
    mil_quality.train(docs, spark.createDataFrame([(one, 1), (two, 0)], "doc_id long, quality int"))
    assert len(fitted) == 2


def test_long_documents_are_fitted_whole(spark, fitted, monkeypatch):
    ids = learned(4)
    docs = spark.createDataFrame([(ids[0], " ".join(f"w{i}" for i in range(20_000)))] + [(i, "short text") for i in ids[1:]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    mil_quality.train(docs, labels)
    assert sorted(map(len, fitted)) == [1, 1, 1, 157]
    fitted.clear()
    monkeypatch.setattr(mil_quality, "MAX_PASSAGES", 2)
    mil_quality.train(docs, labels)
    assert sorted(map(len, fitted)) == [1, 1]


@pytest.mark.parametrize("seed", range(3))
def test_disclosing_spans_equal_brute_force(spark, seed):
    """Names that go with numbers more or less closely, directories of many, copies, hot words."""
    import numpy as np
    from tests.llm import brute
    rng = np.random.default_rng(seed)
    names = [f"{a}{b}" for a in ("Zeb", "Ann", "Li", "Kar", "Tom") for b in ("ulon", "abel", "", "ina")]
    phones = [f"+1 555 010 {i:04d}" for i in range(20)]
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("an", "er", "ol")]

    def text():
        some = list(rng.choice(words, int(rng.integers(2, 9))))
        for i in rng.integers(0, 20, int(rng.integers(0, 3))):
            some += [names[i if rng.random() < 0.7 else int(rng.integers(0, 20))], phones[i] if rng.random() < 0.8 else f"{names[i].lower()}@example.org"]
        rng.shuffle(some)
        return " ".join(some)

    texts = [text() for _ in range(160)]
    texts += texts[:25] + [None, ""] + [" ".join(f"{n} {p}" for n, p in zip(names[:k], phones[:k])) for k in (20, 20, 15)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute.disclosed(texts)
    assert {r.doc_id: r.spans for r in pii_disclosure.personal_data(docs).collect()} == dict(enumerate(want))
    assert any("remove" in w for w in want) and any("general" in w for w in want)


def test_a_directory_is_looked_up_by_its_other_texts(spark):
    """A page of 3,000 names and 500 numbers: no pair of theirs is made but those of the short letters."""
    phones = [f"+1 555 {i // 1000:03d} {i % 1000:04d}" for i in range(500)]
    name = lambda i: "N" + "".join(chr(97 + int(c)) for c in f"{i:05d}")
    page = " ".join(f"{name(i)} {phones[i % 500]}" for i in range(3000))
    letters = [f"{name(i)} wrote from {phones[i]}" for i in range(500)]
    texts = [page, *letters, *fill(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, plain = {}, pii_disclosure.stored
    pii_disclosure.stored = lambda df, what: seen.setdefault(what, plain(df, what))
    try:
        out = {r.doc_id: r.spans for r in pii_disclosure.personal_data(docs).collect()}
    finally:
        pii_disclosure.stored = plain
    assert seen["pii-pairs"].count() < 5_000
    assert all(f"remove:0:{len(name(i))}" in out[1 + i] for i in range(500)) and out[0].count("remove") == 500
