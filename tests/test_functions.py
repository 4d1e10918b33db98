import hashlib
import json
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import books, html, text
from lectern.operators import ingest
from lectern.sources import readers

SPACES = [" a\n ", " x y ", "", "  ", None, "one", "a  b\tc"]


def values(spark, items, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_strip_and_words_follow_unicode(spark):
    assert values(spark, SPACES, text.strip) == [None if s is None else s.strip() for s in SPACES]
    assert values(spark, SPACES, text.word_count) == [len((s or "").split()) for s in SPACES]


def test_tag_sanitising(spark):
    tags = ["Slow Burn", "  slow--burn ", "enemies/to:lovers", "--", "é tag!", "a_b-c", None, "ПРИВЕТ мир"]
    assert values(spark, tags, text.sanitize_tag) == ["slow-burn", "slow-burn", "enemies-to-lovers", "", "é-tag", "a-b-c", None, "привет-мир"]
    assert values(spark, [["B", "b", None, "-", "A"], None, []], text.sanitize_tags, "array<string>") == [["b", "a"], [], []]
    assert values(spark, ["Slow-Burn_x "], text.theme_term) == ["slow burn x"]


def test_budgets(spark):
    assert values(spark, ["a " * 10, None, "w " * 10000], text.token_estimate) == [13, 0, 13000]
    assert values(spark, ["a", "w " * 10000], text.token_budget) == [8192, 39000]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.recursive(st.none() | st.booleans() | st.integers(-(2**40), 2**40) | st.text(max_size=8), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=5), c, max_size=3), max_leaves=8))
def test_content_address_ignores_key_order(record):
    import pandas as pd

    r = {"b": record, "a": 1}
    want = hashlib.sha256(json.dumps(r, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()
    assert ingest._canonical.func(pd.Series([json.dumps(r), json.dumps({"a": 1, "b": record}), None])).tolist() == [want, want, None]


def test_uuid7(spark):
    df = spark.range(200).select(text.uuid7(F.lit("2025-01-01 00:00:00"), F.col("id").cast("string")).alias("u"))
    got = [r.u for r in df.collect()]
    assert len(set(got)) == 200 and all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", u) for u in got)
    assert got == [r.u for r in df.collect()]


def test_thread_identity(spark):
    df = spark.createDataFrame([("https://x/index.php?threads/a%20b.12/",), ("/index.php?threads/c.d.7",), ("nope",)], "u string")
    a, b = text.thread_identity(F.col("u"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [("12", "a b"), ("7", "c.d"), ("", "")]


def test_paragraphs(spark):
    assert values(spark, ["a\n\nb\n \n\nc  ", "", None, "soft-\nened  line"], text.paragraphs) == [["a", "b", "c"], [], None, ["soft-\nened  line"]]
    assert values(spark, ["soft-\nened  line\nnext"], text.joined_lines) == ["softened line next"]


def test_markdown():
    md = html.to_markdown
    assert md("<p>A <b>bold</b> and <i>soft</i> word</p><p>B<br>C</p>") == "A **bold** and *soft* word\n\nB  \nC"
    assert md("<ul><li>x<li>y</ul><ol><li>1</li><li>2</li></ol>") == "* x\n* y\n\n1. 1\n2. 2"
    assert md("<blockquote>said<p>more</p></blockquote>") == "> said\n>\n> more"
    assert md("<h2>T</h2><a href='/u'>l</a> <script>x</script><img src='i' alt='a'>") == "## T\n\n[l](/u) ![a](i)"
    assert md(None) is None and md("") == "" and md("plain &amp; text") == "plain & text"
    assert md("<div>" * 500 + "deep") == "deep" and md("</b>stray<b>") == "stray"


@settings(max_examples=100, deadline=None)
@given(st.text("<>/abp i\"'=&;\n", max_size=60))
def test_markdown_never_fails(s):
    assert isinstance(html.to_markdown(s), str) and isinstance(html.posts(s), list)


PAGE = """<html><head><title>Page</title></head><body><h1 class="p-title-value">The Thread</h1>
<article class="message message--post js-post" data-author="Ann" data-content="post-11" id="js-post-11"><meta itemprop="parentItem" itemid="https://f/index.php?threads/the-thread.5/post-11">
<a class="username" data-user-id="9">Ann</a><time datetime="2020-01-01T10:00:00+0200"></time><a href="/index.php?posts/11/">link</a><div class="message-userContent"><article class="message-body"><div class="bbWrapper">Hello <b>you</b></div></article></div></article>
<article class="message message--post" id="js-post-12"><a href="/index.php?threads/the-thread.5/post-12">x</a><article class="message-body">Two</article></article>
<article class="message message--post"><a href="/index.php?threads/other.6/">t</a><a href="/posts/13/">p</a><div class="bbWrapper">Three</div></article>
<article class="message message--post" data-content="post-14"><div class="bbWrapper">no thread</div></article>
<article class="message message--post" data-content="post-15"><a href="/index.php?threads/other.6/">t</a><div class="bbWrapper"> </div></article>
<article class="message">not a post</article></body></html>"""


def test_forum_posts():
    got = html.posts(PAGE)
    assert [(p["post_id"], p["thread_id"], p["thread_slug"]) for p in got] == [("11", "5", "the-thread"), ("12", "5", "the-thread"), ("13", "6", "other")]
    assert got[0]["text"] == "Hello <b>you</b>" and got[0]["author_id"] == "9" and got[0]["timestamp"].endswith("+0200") and got[0]["thread_title"] == "The Thread"
    assert html.posts(None) == [] and html.posts("<p>error</p>") == []


BOOK = """front
*** START OF THE EBOOK ***
FOREWORD

CHAPTER I
FIRST NAME

CHAPTER II
SECOND NAME

FOREWORD

Before every-
thing.

CHAPTER I
FIRST NAME

One [1] para.

[Illustration: a
picture]

[1] A note.

Two.

CHAPTER II
SECOND NAME

[2] Lost note.

Last.
*** END OF THE EBOOK ***
tail"""


def test_book(spark):
    rows = ingest.book_paragraphs(spark.createDataFrame([("b", BOOK), ("none", None)], "native_id string, text string"))
    got = [(r.title, r.item_id, r.text, r.annotation) for r in rows.orderBy("paragraph_no").collect()]
    assert got == [
        ("FOREWORD", "narrative-000001", "Before everything.", None),
        ("CHAPTER I: FIRST NAME", "narrative-000002", "One [1] para.", "[1] A note."),
        ("CHAPTER I: FIRST NAME", "narrative-000003", "Two.", None),
        ("CHAPTER II: SECOND NAME", "narrative-000004", "Last.", None),
    ]
    seq = {r.item_id: r.item_ids for r in ingest.book_sequences(rows).collect()}
    assert len(seq) == 4 and seq["seq-book-000001"] == [f"narrative-{i:06d}" for i in range(1, 5)]


def test_book_in_splits_and_blocks(spark, tmp_path):
    """Wherever a file is split and however small the blocks are, a book has the paragraphs of its whole text, and no row holds much of it."""
    names = "I II III IV V VI VII VIII IX".split()
    part = "\n\n".join(f"Para {i} of it.\n\n[{i}] Note\non {i}.\n \n[{i}] Second." if i % 3 else f"Lone {i}\nline.\n\n[Illustration: a\npicture]\r\n\r\nTail." for i in range(40))
    heads = [f"CHAPTER {n}\n\n\nNAME {n}" for n in names]
    whole = "front\n*** START OF IT ***\n" + "\n\n".join(heads) + "\n\nFOREWORD\n\nHello.\n\n" + "\n\n".join(f"{h}\n\n[9] Lost.\n\n{part}" for h in heads) + "\n*** END OF IT ***\ntail"
    fields = ["native_id", "section_no", "title", "paragraph_no", "text", "annotation"]
    read = lambda df, **k: sorted(ingest.book_paragraphs(df, **k).select(fields).collect())
    want = read(spark.createDataFrame([("b", whole)], "native_id string, text string"))
    assert len(want) == 1 + 9 * 54 and want[0][2] == "FOREWORD" and [r[3] for r in want] == list(range(1, len(want) + 1))
    assert want[1][2:] == ("CHAPTER I: NAME I", 2, "Lone 0 line.", None) and want[3][4:] == ("Para 1 of it.", "[1] Second.")
    (tmp_path / "book.txt").write_text(whole, newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split, block in (("700", 1), ("3000", 200)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            lines = readers.book(spark, str(tmp_path / "book.txt"), "b")
            assert read(lines, block=block) == want
            longest = ingest._book_blocks(lines, "native_id", "text", block).agg({"text": "string_agg"}).first()[0]
            assert len(longest) == len(whole) + 1
            assert ingest._book_blocks(lines, "native_id", "text", block).selectExpr("max(length(text))").first()[0] < 1500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_book_lists_ids_without_gathering_paragraphs(spark, tmp_path):
    """The ids of sections and of the whole book come from ranges of numbers; they failed for memory where rows were collected."""
    para = "\n\n".join(f"Para {i}.\n\n[1] Note {i}." for i in range(60))
    (tmp_path / "book.txt").write_text("front\n*** START OF IT ***\n" + "\n\n".join(f"CHAPTER {n}\nNAME\n\n{para}" for n in ("I", "II", "III")) + "\n*** END OF IT ***\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        ledger = spark.createDataFrame([], "source string, native_id string, uuid string, meta string, recorded_at timestamp")
        c = ingest.books(readers.book(spark, str(tmp_path / "book.txt"), "b"), ledger, F.lit("2025-01-01").cast("timestamp"))
        assert "collect_list" not in c.items._jdf.queryExecution().toString()
        rows = c.items.orderBy("item_pos").collect()
        assert c.variants.selectExpr("count(annotation)", "count(distinct item_id)").first() == (180, 180)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    ids = [f"narrative-{i:06d}" for i in range(1, 181)]
    assert [r.item_pos for r in rows] == list(range(184)) and [r.item_id for r in rows[:180]] == ids
    assert {r.item_id: r.item_ids for r in rows[180:]} == {"seq-book-000001": ids} | {f"seq-chapter-{k + 1:06d}": ids[60 * k : 60 * k + 60] for k in range(3)}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("a[]1 \t\r\n\n\n\x0b\x1c\x85\xa0\u1680\u2028\u3000\u180e\u200b", max_size=30), min_size=5, max_size=20))
def test_book_paragraphs_are_parted_like_columns(spark, texts):
    texts = [t.replace("[", "(") for t in texts]
    assert [[p for p, _, _ in books.noted_paragraphs(t)] for t in texts] == values(spark, texts, text.paragraphs)


def test_unicode_normal_form_is_left_alone(spark):
    s = unicodedata.normalize("NFD", "é")
    assert values(spark, [s], text.strip) == [s]
