import pytest

from lectern.llm.language import document_languages, label_code, language_segments, missing_labels
from pyspark.sql import functions as F

DE = "Der alte Fährmann suchte den verlorenen Schlüssel hinter der Kapelle, aber es war schon viel zu spät für alle."
EN = "The old ferryman was looking for the lost key behind the chapel, but it was already much too late for them."
FR = "Le vieux passeur cherchait la clé perdue derrière la chapelle, mais il était déjà beaucoup trop tard pour eux."
SCHEMA = "doc_uuid string, variant_id long, text string, lang string, segment_no int"


@pytest.fixture(scope="module")
def samples(spark, data):
    return spark.read.parquet(f"{data}/lang_samples.parquet")


def frame(spark, rows):
    return spark.createDataFrame([(d, i, t, "xx", 9) for i, (d, t) in enumerate(rows)], SCHEMA)


def test_stretches(spark, samples):
    rows = [("a", f"{EN} {DE}\n\n{EN}"), ("b", f"<p>{FR}</p>"), ("c", None), ("d", ""), ("e", "... !!"), (None, EN), ("f", " ".join([DE] * 400)), ("b", f"<p>{FR}</p>")]
    got = {}
    for r in language_segments(frame(spark, rows), samples).orderBy("variant_id", "segment_no").collect():
        got.setdefault(r.variant_id, []).append(r)
    assert [r.lang for r in got[0]] == ["en", "de", "en"] and set(got) == {0, 1, 6, 7}
    assert got[0][0].char_begin == 0 and got[0][0].char_end == got[0][1].char_begin and got[0][2].char_end == len(rows[0][1])
    assert rows[0][1][got[0][1].char_begin :].startswith("Der alte")
    assert [r.lang for r in got[1]] == ["fr"] and [(r.lang, r.n_words) for r in got[6]] == [("de", 400 * len(DE.split()))]
    assert all(0 <= r.confidence <= 1 for rs in got.values() for r in rs)
    assert language_segments(frame(spark, []), samples).count() == 0


def test_documents_and_missing_labels(spark, samples):
    seg = language_segments(frame(spark, [("a", f"{EN} {EN} {DE}"), ("b", FR)]), samples)
    top = {r.doc_uuid: r for r in document_languages(seg).collect()}
    assert top["a"].lang == "en" and top["a"].n_langs == 2 and top["b"].lang == "fr" and top["b"].share == 1.0
    items = spark.createDataFrame([("a", "categorization", "language", ["Englisch", "eng"]), ("b", "categorization", "language", None), ("b", "categorization", "language", ["und", ""])], "doc_uuid string, kind string, category string, value array<string>")
    assert {tuple(r) for r in missing_labels(seg, items).collect()} == {("a", "de"), ("b", "fr")}


def test_labels(spark):
    rows = [("en-GB", "en"), ("en_US", "en"), ("ENG", "en"), (" English ", "en"), ("fre", "fr"), ("de-AT", "de"), ("und", None), ("unknown", None), ("", None), (None, None), ("xx", None), ("English, French", None)]
    got = spark.createDataFrame(rows, "l string, want string").withColumn("got", label_code(F.col("l"))).collect()
    assert all(r.got == r.want for r in got)


def test_held_out_accuracy(spark, samples):
    """Profiles fitted on two thirds of the samples name the language of every 12 words of the rest."""
    from lectern.llm.language import Profiles

    rows = samples.orderBy("sample_id").collect()
    p = Profiles([(r.lang, r.text) for r in rows if r.sample_id % 3])
    right = total = 0
    for r in rows:
        if r.sample_id % 3 == 0:
            ws = r.text.split()
            parts = [" ".join(ws[i : i + 14]) for i in range(0, max(1, len(ws) - 14), 14)]
            for path in p.paths(parts, 0.6, 0.7):
                right += max(path, key=lambda x: x[1] - x[0])[2] == p.langs.index(r.lang)
                total += 1
    assert total > 150 and right / total > 0.97, (right, total)


def test_stretches_inside_a_sentence(spark, samples):
    """Held-out stretches of 12 to 20 words inside English text, without a sentence end around them."""
    import random

    from lectern.llm.language import Profiles
    from lectern.llm.words import WORD

    rows, r = samples.orderBy("sample_id").collect(), random.Random(4)
    p = Profiles([(x.lang, x.text) for x in rows if x.sample_id % 3])
    words = {k: [w for x in rows if x.lang == k and not x.sample_id % 3 for w in WORD.findall(x.text)] for k in p.langs}
    texts, want = [], []
    for k in p.langs:
        for n in (12, 14, 16, 20) * 8:
            at, e = r.randrange(len(words[k]) - n), r.randrange(len(words["en"]) - 60)
            texts.append(" ".join(words["en"][e : e + 20] + words[k][at : at + n] + words["en"][e + 20 : e + 35]))
            want.append(k)
    found = [any(x[2] >= 0 and p.langs[x[2]] == k and x[1] - x[0] >= 12 for x in path) for k, path in zip(want, p.paths(texts, 0.6, 0.7)) if k != "en"]
    assert sum(found) / len(found) >= 0.9


def test_no_language_for_names_numbers_and_codes(spark, samples):
    rows = [
        ("names", "Orgolas Yorselth Rybelane Pelvane Miphamund Tamven Ilgoric Orneven Velquilas Toros Ulnuyn Besazar Aninuette Vermazar"),
        ("numbers", " ".join(map(str, range(1000, 1014)))),
        ("codes", "x7kq a0b3z q8Dlv w6sx m4nop 8h2fd kk9s0 zz1xc p0o9i u8y7t r5e4w q2a1z x3c2v b1n0m"),
        ("greek", "Ο παλιός βαρκάρης έψαχνε το χαμένο κλειδί πίσω από το παρεκκλήσι αλλά ήταν πολύ αργά"),
    ]
    seg = language_segments(frame(spark, rows), samples).collect()
    assert {x.doc_uuid for x in seg} == {"names", "numbers", "codes", "greek"} and all(x.lang == "und" for x in seg)
    items = spark.createDataFrame([], "doc_uuid string, kind string, category string, value array<string>")
    assert missing_labels(language_segments(frame(spark, rows), samples), items).count() == 0


def test_place_in_a_long_text_does_not_matter(spark, samples):
    from lectern.llm.language import Profiles

    p = Profiles([(x.lang, x.text) for x in samples.collect()])
    stretch = FR.replace(",", "").replace(".", "").lower()
    before = len(EN.split())
    for k in (4096 // before, 4096 // before + 1, 300):
        path = p.paths([" ".join([EN] * k + [stretch] + [EN] * 3)], 0.6, 0.7)[0]
        assert any(x[2] == p.langs.index("fr") and x[1] - x[0] >= 12 for x in path), k
