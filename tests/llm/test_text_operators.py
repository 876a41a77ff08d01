"""Extraction, packing, exact dedup, WARC and BPE against references, round trips and small cases."""

import array
import hashlib
import html
import time
import zlib
from collections import Counter

import pytest
import public_tokenizers
import tiktoken
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import oracle
from indexloom.llm import bpe, exact_dedup, html_extract, packing, registry, warc

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, n_bytes long"
ODD = [None, "", "x", "X", " \n\t ", "<|endoftext|> a", "I'm  fine\x1c\xa0 ²½ 日本語", "ab" * 5000, "É" * 300, "\U0001f600 é"]


# ---------------------------------------------------------------- HTML


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("<p>", ""),
        ("<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href='/'>Home</a></nav><article><h1>A &amp; B</h1><p>one\n <b>two<br>three<p>Of.</article><footer>f</footer>", "A & B\none two three\nOf."),
        ("<main><p>first</p><div class='ad'>buy</div><p>second</p><section id=comments><p>nice</p></section></main>", "first\nsecond"),
        ("<article>a<aside>s</aside><form><p>q</p></form>b<div class='cookie-notice'>c</div></article>", "a\nb"),
        ("<article><p>body</p><article class='comment'><p>mine</p></article></article>", "body"),
        ("<div><a href=x>one link</a> <a href=y>two link</a></div><div class=post><p>" + "Plain text runs on. " * 8 + "</p><p>End.</p></div><ul><li><a href=z>more</a></li></ul>", ("Plain text runs on. " * 8).strip() + "\nEnd."),
        ("<article><p title='a>b'>x &lt;y&gt; &#233;&eacute;</p><!-- <p>no</p> --><style>p{}</style></article>", "x <y> éé"),
        ("<body class='no-sidebar'><article><p>kept</p></article>", "kept"),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


PARAGRAPH = "Plain text runs on and on. " * 8


@pytest.mark.parametrize(
    "page,text",
    [
        # Teasers that are articles, the body elsewhere.
        (f"<article>teaser</article><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>", f"{PARAGRAPH.strip()}\n{PARAGRAPH.strip()}"),
        # Class names alone don't take prose out of an article.
        (f"<article><p>{PARAGRAPH}</p><div class='related-work'>Others did it too.</div><p class='side'>Left.</p></article>", f"{PARAGRAPH.strip()}\nOthers did it too.\nLeft."),
        # Prose in boilerplate stays out however long it is, in and beside the article.
        (f"<nav><p>{PARAGRAPH}</p></nav><main><h1>T</h1><p>{PARAGRAPH}</p><div class='post-comments'><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div></main><footer>{PARAGRAPH}</footer>", f"T\n{PARAGRAPH.strip()}"),
        ("<nav>Home</nav><footer>only a footer</footer>", ""),
        # No marks at all: short lines before the surge and after the dive go, those between stay.
        (f"<div>Sign in</div><div><p>{PARAGRAPH}</p><p>No.</p><p>{PARAGRAPH}</p></div><hr><hr><hr><div>Imprint</div>", f"{PARAGRAPH.strip()}\nNo.\n{PARAGRAPH.strip()}"),
        (f"<p>one <a href='x>y'>z</a> <b class=\"q>two {PARAGRAPH}", f"one z two {PARAGRAPH.strip()}"),
    ],
)
def test_distribution_decides(page, text):
    assert html_extract.main_text(page) == text


def test_distribution_decides_on_real_pages(spark):
    """With a threshold that anything reaches, adverts and footers come in; nothing else keeps them out."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect() if r["html"]]
    assert sum(html_extract.main_text(p, surge=1) != html_extract.main_text(p) for p in pages) > len(pages) / 2


def surges(weight, n_chars, window, surge, dive):
    """Lines that stay, by the definition: a line is in if since the last surge no window was below the dive."""
    n = len(weight)
    total = [sum(weight[j] for j in range(n) if i <= j < i + window) for i in range(n)]
    part = surge / window
    begins = [i for i in range(n) if total[i] >= surge and weight[i] >= part]
    inside = [any(all(total[j] >= dive for j in range(b, i + 1)) for b in begins if b <= i) for i in range(n)]
    return [i for i in range(n) if inside[i] and n_chars[i] and (weight[i] >= part or weight[i] >= n_chars[i] / 2)]


@given(st.lists(st.tuples(st.sampled_from(["", "x", "word " * 6, PARAGRAPH]), st.integers(0, 5), st.booleans(), st.booleans(), st.booleans()), max_size=14))
@settings(max_examples=300, deadline=None)
def test_distribution_like_definition(made):
    rows = [html_extract.Line(t.strip(), min(linked, len(t.strip())), a, b, h) for t, linked, a, b, h in made]
    weight = html_extract.weights(rows)
    at = [i for i, r in enumerate(rows) if r.text and not r.boilerplate]
    most = max((sum(weight[i : i + 3]) for i in at), default=0)
    surge = html_extract.SURGE if most >= html_extract.SURGE else most / 2
    want = [rows[i].text for i in surges(weight, [len(r.text) for r in rows], 3, surge, min(html_extract.DIVE, surge))] if surge else []
    original = html_extract.lines
    html_extract.lines = lambda page: rows
    try:
        assert html_extract.main_text("") == "\n".join(want)
    finally:
        html_extract.lines = original


@pytest.mark.parametrize("bad", ["<a <b <c ", "<a href=\"x' ", "<p><b>", "<", "&amp", "<a href='", "<li><b><p>", "</i>", "<!-", "<textarea>"])
def test_broken_pages_take_linear_time(bad):
    """Twenty times the page takes nothing like four hundred times as long."""
    took = []
    for size in (10_000, 200_000):
        page = "<b>" * (size // 3) + bad * (size // len(bad))
        began = time.process_time()
        html_extract.main_text(page)
        took.append(time.process_time() - began)
    assert took[1] < 100 * max(took[0], 0.005)


def test_extract_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", "<article>a</article>", 1), (1, "u", "<article>a</article>", 1), (None, None, None, None)], "page_id long, url string, html string, n_chars int")
    assert sorted(map(tuple, html_extract.extract(df).collect()), key=str) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert html_extract.extract(df.limit(0)).collect() == []


@given(st.text())
@settings(max_examples=100, deadline=None)
def test_any_page_parses(page):
    html_extract.main_text(page)
    assert html_extract.main_text(f"<article><p>{html.escape(page)}</p></article>") == " ".join(page.split()) or "\r" in page or "\x00" in page


# ---------------------------------------------------------------- exact dedup and WARC, by SQL and small cases


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op5_warc"])
def test_like_sql(spark, name):
    assert oracle.compare(registry.queries()[name](spark, SF), oracle.connect(SF), registry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("digests", [True, False])
def test_exact_dedup_cases(spark, digests):
    long = "p" * 100
    rows = [(1, "Abc"), (2, "aBC"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, long + "a"), (8, long + "b"), (9, long + "A"), (None, "abc"), (11, "z" * 200_000)]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], DOCS)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(spark, df, digests).collect()}
    assert got == {1: (2, 3, False), 2: (2, 3, True), None: (2, 3, False), 3: (4, 2, False), 4: (4, 2, True), 5: (5, 1, True), 6: (6, 1, True), 7: (9, 2, False), 9: (9, 2, True), 8: (8, 1, True), 11: (11, 1, True)}
    assert exact_dedup.exact_dedup(spark, df.limit(0), digests).collect() == []


def test_archives_round_trip(spark):
    big = "<p>" + "long \r\n\r\nWARC/1.1\r\n é " * 50
    rows = [(5, "http://a\r\nb", big), (3, "u3", big), (9, None, big), (1, "s", "short"), (2, "s", "short"), (7, "n", None), (None, "x", big), (3, "again", big)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int")
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["payload"]) for r in warc.archive_pages(spark, df).collect()), key=str)
    want = []
    for page, _, body in rows:
        raw = (body or "").encode()
        revisit = len(raw) >= 100 and page != 3
        want.append((page, "revisit" if revisit else "response", 3 if revisit else None, len(raw), hashlib.sha256(raw).hexdigest(), None if revisit else body or ""))
    assert got == sorted(want, key=str)
    assert warc.archive_pages(spark, df.limit(0)).collect() == []


# ---------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def encoder():
    tokens = bpe.load_ranks(BPE)
    return bpe.Encoder(tokens), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens) if t}, special_tokens={})


def test_perfect_hash_is_minimal(encoder):
    mine, _ = encoder
    assert sorted(mine.hash.slot(t) for t in mine.tokens if t) == list(range(sum(map(bool, mine.tokens))))
    assert all(mine.lookup(t) == i for i, t in enumerate(mine.tokens) if t)


@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn", "Co"])))
@example("a" * 2000)
@example("  x　\x85y \n\n z'll 12²½ \x1c\x1f")
@settings(max_examples=200, deadline=None)
def test_like_tiktoken(encoder, text):
    mine, theirs = encoder
    ids = bpe.encode_text(bpe.PieceCache(mine.piece_ids), text)
    assert memoryview(ids).cast("I").tolist() == theirs.encode_ordinary(text)
    assert bpe.decode_ids(mine.tokens, ids) == text.encode()


def test_encode_rows(spark, encoder):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, "x", 1)], DOCS)
    rows = bpe.encode(df, BPE).collect()
    for r in rows:
        text = "x" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        ids = encoder[1].encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(array.array("I", ids).tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert len(rows) == len(ODD) + 1
    assert bpe.encode(df.limit(0), BPE).collect() == []


# ---------------------------------------------------------------- packing


def check_packing(pieces, docs, capacity=2048):
    """Every id in one piece; sequences gapless, within the capacity, and none padded."""
    t = Tokenizer.from_file(JSON)
    ids = {d: [*t.encode(x or "", add_special_tokens=False).ids, 1] for d, x in docs}
    at, sequences = {}, {}
    for doc, start, length, crc, total, sequence, offset in sorted(pieces, key=lambda p: (p[0], p[1])):
        assert start == at.get(doc, 0) and length > 0 and total == len(ids[doc])
        assert crc == zlib.crc32(array.array("I", ids[doc][start : start + length]).tobytes())
        at[doc] = start + length
        sequences.setdefault(sequence, []).append((offset, length))
    assert at == {d: len(x) for d, x in ids.items()}
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity and end & (end - 1) == 0
    return sequences


def test_pack_sf(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in packing.pack(docs.repartition(3), JSON).collect()]
    check_packing(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_sequences_do_not_depend_on_partitions(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    for window, every in ((1 << 20, (1, 8, 64)), (3000, (16,))):  # one turn more, and several
        monkeypatch.setattr(packing, "WINDOW", window)
        for parts in every:
            rows = packing.pack(docs.repartition(parts), JSON).collect()
            check_packing([tuple(r) for r in rows], [tuple(r) for r in docs.select("doc_id", "text").collect()])
            sizes = Counter()
            for r in rows:
                sizes[r["sequence_id"]] += r["length"]
            full, rest = divmod(sum(sizes.values()), 2048)
            assert sorted(sizes.values()) == sorted([2048] * full + [1 << i for i in range(11) if rest >> i & 1])


def test_least_cost_sequence_with_room(monkeypatch):
    """Each piece goes where a search through all sequences would put it."""
    seen = []
    take = packing._Open.take

    def checked(self, room):
        every = [(c, i, r) for r, heap in enumerate(self.heaps) for c, i in heap if r >= room]
        got = take(self, room)
        assert (got is None) == (not every) and (not every or got[0] == min(every)[0])
        seen.append(got)
        return got

    monkeypatch.setattr(packing._Open, "take", checked)
    packing.pack_window([(i, 0, 1 + i * 37 % 63, 0, bytes(4 * (1 + i * 37 % 63))) for i in range(200)], 64)
    assert len(seen) > 200


def test_pack_odd_texts(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)], DOCS)
    check_packing([tuple(r) for r in packing.pack(df, JSON).collect()], list(enumerate(ODD)))
    assert packing.pack(df.limit(0), JSON).collect() == []


@given(st.lists(st.integers(1, 300), max_size=60))
@settings(max_examples=60, deadline=None)
def test_pack_window_keeps_all_and_balances(lengths):
    pieces = [(i, 0, n, n, bytes(4 * n)) for i, n in enumerate(lengths)]
    full, rest = packing.pack_window(pieces, 64)
    assert all(sum(p[2] for p in s) == 64 for s in full) and sum(p[2] for p in rest) == sum(lengths) % 64
    got = sorted((p[0], p[1], p[2]) for s in [*full, rest] for p in s)
    for i, n in enumerate(lengths):
        end = 0
        for d, start, length in got:
            if d == i:
                assert start == end
                end += length
        assert end == n


def test_both_matchers_agree_on_all_low_characters():
    """The faster matcher has the classes of the other one, for each character below U+0250 among others."""
    for c in map(chr, range(0x250)):
        text = f"a{c}1 {c}{c} {c}'s!{c}\n{c} "
        assert bpe._LOW.findall(text) == bpe._ANY.findall(text)
        assert "".join(bpe.pre_tokens(text)) == text


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_archives_of_several_files(spark, monkeypatch, tmp_path, few):
    """Small files, a page larger than a file, and repeated digests by broadcast or by join give the same records."""
    monkeypatch.setattr(warc, "FEW_DIGESTS", few)
    rows = [(i, f"http://h/{i}", "x" * 150 + str(i % 5)) for i in range(40)] + [(100, None, "é" * 30_000), (101, "u", None), (101, "u", None), (None, None, "x" * 150 + "0")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = warc.archive_pages(spark, df, str(tmp_path / "w"), file_bytes=2000).collect()
    assert len(list((tmp_path / "w").glob("*.gz"))) > 3 and len(got) == len(rows)
    assert {(r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["page_id"] != 101} == {
        (i, "response" if i == 100 or i is not None and i < 5 else "revisit", None if i == 100 or i is not None and i < 5 else (i or 0) % 5) for i, _, _ in rows if i != 101
    }


def test_long_page():
    page = "<main>" + "<p>Some words of prose that go on and on.</p>" * 30_000 + "</main>"
    assert html_extract.main_text(page).count("\n") == 29_999
