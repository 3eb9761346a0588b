import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import chat, contain, html, jaccard, kernel, pieces, quality, secrets, shards, spans, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\x0b\x0c\r"


def docs(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).repartition(3)


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def grams(text, k=5):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# Kernel -----------------------------------------------------------------


def test_kernel_words_and_shingles():
    texts = ["a b c d e f", "", None, "A b", "x  \n y\tz q w", "ABC é", "  ", "one"]
    seen, back = {}, {}
    for first, end, s, at in kernel.shingle_rows(pa.array(texts)):
        for i in range(first, end):
            w = words_of(texts[i])
            want = [tuple(w[j : j + 5]) for j in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
            got = s[at[i - first] : at[i - first + 1]].tolist()
            assert len(got) == len(want)
            for a, b in zip(want, got, strict=True):
                assert seen.setdefault(a, b) == b and back.setdefault(b, a) == a


def test_kernel_sentences():
    texts = ["One two. Three! four\nfive six", "", "x.", None, "a b. \n\n c"]
    data, offsets = kernel.buffers(pa.array(texts))
    h, words, start, rows = kernel.sentences(data, offsets)
    assert np.diff(rows).tolist() == [4, 0, 1, 0, 2] and words.tolist() == [2, 1, 1, 2, 1, 2, 1]


# 1 secrets --------------------------------------------------------------


def base_spans(t):
    a = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in a.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_secret_base_spans(spark):
    rng = random.Random(1)
    parts = ["token=", "secret : ", "PASSWORD='", "api_key=", "apikey:", "AKIA", "AKIA1234567890AB", "deadbeef" * 4, "deadbeef" * 3, "abc", "abcdefgh", "==", " ", "\n", "é\U0001d4b3", "x.y-z_", "'\"", "secret=secret:abcdefghij", "token=token=12345678"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(300)] + ["", None, "token=abcdefgh " * 700]
    got = {r["doc_id"]: [(s["start"], s["rank"], s["end"]) for s in r["spans"] if s["rank"] < 3] for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    assert got == {i: base_spans(t or "") for i, t in enumerate(texts)}


def test_secret_battery(spark):
    rng = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(alphabet) for _ in range(44)) for _ in range(60)]
    plain = ["internationalization_of_configuration-management", "the-quick-brown-fox-jumps-over-the-lazy-dog", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890123456789012345678901234567890"]
    texts = [f"x {k} y" for k in keys] + [f"x {p} y" for p in plain * 30]
    got = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "random"] for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    assert sum(len(got[i]) for i in range(60)) >= 54 and all(not got[i] for i in range(60, len(texts)))
    assert all((s["start"], s["end"]) == (2, 46) for i in range(60) for s in got[i])


def test_secret_battery_finds_short_keys(spark):
    rng = random.Random(22)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(alphabet) for _ in range(16)) for _ in range(50)]
    plain = ["internationalization", "misunderstanding", "Straightforward", "congratulations", "aaaaaaaaaaaaaaaa", "responsibilities"]
    texts = [f"x {k} y" for k in keys] + [f"x {p} y" for p in plain * 40]
    got = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "random"] for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    assert sum(len(got[i]) for i in range(50)) >= 40 and all(not got[i] for i in range(50, len(texts)))


def test_secret_tokens_end_at_equals_signs_and_in_mixed_paths():
    a, b, c = "Ab1" * 8, "x/y+Z9" * 5, "q-r_S7" * 5
    text = f"KEY_NAME={a} sig={b}== ?auth={c}&x {a}={c} /my_dir/{a}/x-y/{c} d_e/{'n+m' * 8}/z {a}+{c} short=ab {b} {c}"
    assert re.findall(secrets.TOKEN, text) == [a, b + "==", c, a + "=", c, a, c, "n+m" * 8, a, c, b, c]


def test_secret_battery_reads_values_and_paths(spark):
    rng = random.Random(20)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(alphabet) for _ in range(44)) for _ in range(60)]
    texts = [("AWS_ACCESS_KEY={}", "https://h.example/f?sig={}", "/home/my_files/{}/x")[i % 3].format(k) for i, k in enumerate(keys)] + ["some_internationalization_of=the-quick-brown-fox-jumps-over-the-lazy-dog"] * 90
    got = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "random"] for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    assert sum(len(got[i]) for i in range(60)) >= 54 and all(not got[i] for i in range(60, len(texts)))
    assert all(texts[i][s["start"] : s["end"]] == keys[i] for i in range(60) for s in got[i])


def test_secret_thresholds_hold_the_false_discovery_rate():
    assert secrets.thresholds([("hex", 10, 0, 90), ("hex", 10, 20, 10)], 0.01) == {("hex", 10): 20}
    assert secrets.thresholds([("hex", 10, 0, 90), ("hex", 10, 4, 10)], 0.01) == {}


def test_redact(spark):
    df = spark.createDataFrame([("ab\U0001d4b3secret cd", [(3, 9), (5, 9)]), ("x", [])], "t string, s array<struct<start:int,end:int>>")
    assert {r[0] for r in df.select(secrets.redact(F.col("t"), F.col("s"))).collect()} == {"ab\U0001d4b3[SECRET] cd", "x"}


# 2 html -----------------------------------------------------------------

PAGE = """<html><body><header><h1>Site</h1></header><div class="wrap"><div class="menu"><ul><li>a</li></ul></div><div class="post-{n} content"><h1>Title &amp; x</h1><p>Hello <b>wor</b>ld&nbsp;ok<p>second
 <a href="q">link</a> para {n}<div class="ad-box">BUY</div><ul><li>one<li>two</ul><form>f</form></div><div id="comments"><p>nice</p></div><aside>s</aside></div><footer>f</footer><script>var x="<p>no</p>"</script></body></html>"""


def test_pages(spark):
    rows = [(i, f"https://Host.example/{i}", PAGE.format(n=i)) for i in range(6)]
    rows += [(6, "https://host.example/x", "<p>short"), (7, None, None), (8, "bad url", ""), (9, "http://t.example", "<article><h1>A</h1><p><b>B<br><p>C &lt;d&gt;</article><footer>f"), (9, "http://t.example", "<article><p>cut <im")]
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    want = [(i, t, len(t)) for i in range(6) for t in [f"Title & x Hello world ok second link para {i} one two"]]
    assert got[:6] == want and got[6:] == [(6, "short", 5), (7, "", 0), (8, "", 0), (9, "A B C <d>", 9), (9, "cut", 3)]
    assert html.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_keep_all_elements_of_the_winning_path(spark):
    story = "<div class='story'><h2>{0}</h2><p>" + "some words of the story. " * 5 + "</p></div>"
    one, said = "<body>" + story + "</body>", " ".join(["some words of the story."] * 5)
    two = "<body>" + story.format("First") + "<div class='advert'>BUY</div>" + story.format("Second") + "</body>"
    wider = "<body><section><p>" + "other words, far more of them. " * 30 + "</p></section>" + story.format("Small") + "</body>"
    rows = [(i, f"http://h.example/{i}", one.format(i)) for i in range(40)] + [(40, "http://h.example/40", two), (41, "http://h.example/41", wider)]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == f"3 {said}" and got[40] == f"First {said} Second {said}"
    assert got[41] == " ".join(["other words, far more of them."] * 30) + f" Small {said}"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<div><p>Lead.</p><div class='body'><p>{0}</p></div><p><a>More</a></p></div>", "Lead. {0} More"),
        ("<article><p>{0}</p></article><article><p>Second.</p></article>", "{0} Second."),
        ("<div class='body'><p>{0}</p></div><div class='advert'>BUY</div><ul><li><a>link</a></ul>", "{0}"),
        ("<main><p>{0}</p><figure><figcaption>Seen here.</figcaption></figure><p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.<noscript>Still</noscript></main>", "{0} Seen here. If x=1.Still"),
    ],
)
def test_pages_lose_nothing_outside_the_largest_element(page, want):
    long = " ".join(["word"] * 60)
    assert html.extract("<body>" + page.format(long) + "</body>", None)[0] == want.format(long)


def test_pages_keep_content_inside_the_article():
    page = '<article><h1>T</h1><p>a</p><pre><code>x = 1 <span class="comment"># keep me</span></code></pre><figure><figcaption>Caption text</figcaption></figure><p>Sum <math><mi>x</mi></math> end</p><div class="ad">BUY</div><section class="comments"><p>nice</p></section></article>'
    assert html.extract(page, None)[0] == "T a x = 1 # keep me Caption text Sum x end"


def hosts_by_hand(pages):
    """The votes of pages (host, html), counted exactly: {host: (paths, boilerplate)}."""
    best, seen = {}, {}
    for host, page in pages:
        for path, size, text, article in html.page_votes(page):
            if text is None:
                best.setdefault(host, {}).setdefault(path, []).append(size)
            else:
                seen.setdefault(host, {}).setdefault(path, set()).add((text, article))
    out = {}
    for host in {*best, *seen}:
        paths = [p for _, p in sorted((-sum(x), p) for p, x in best.get(host, {}).items() if len(x) > 1)]
        gone = set()
        for p, x in seen.get(host, {}).items():
            texts, articles = ({y[i] for y in x} for i in (0, 1))
            if len(articles) >= html.LEAST_PAGES and 2 * len(texts) <= len(articles) and p not in best.get(host, {}):
                gone.add(p)
        if paths or gone:
            out[host] = (paths, gone)
    return out


def test_host_votes_decide(spark):
    """Several layouts a host: an unmarked notice goes because the host's pages agree on it; the same block with a text of its own stays."""
    rng = random.Random(21)
    story = lambda: prose(rng, 80)
    layouts = [
        "<body><div class='x1'><p>We set files on your device.</p></div><div class='story'><h1>H</h1><p>{a}</p></div></body>",
        "<body><article><h1>H</h1><p>{a}</p><div class='q'><p>Read our letter!</p></div><p>{b}</p></article></body>",
        "<body><table><tr><td><p>{a}</p><ul class='z'><li>{c}</li></ul></td></tr></table></body>",
    ]
    pages, want = [], []
    for i in range(36):
        a, b, c = story(), story(), prose(rng, 6)
        pages.append(("one.example", layouts[i % 3].format(a=a, b=b, c=c)))
        want.append([f"H {a}", f"H {a} {b}", f"{a} {c}"][i % 3])
    pages += [("two.example", layouts[0].format(a=(a := story())))] * 9  # copies of one article: nothing says what is boilerplate
    want += [f"We set files on your device. H {a}"] * 9
    rows = [(i, f"http://{h}/{i}", p) for i, (h, p) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r["host"]: (r["paths"], set(r["boilerplate"])) for r in html.host_paths(df).collect()} == hosts_by_hand(pages)
    got = {r["page_id"]: r["text"] for r in html.extract_pages(df).collect()}
    assert [got[i] for i in range(len(pages))] == want
    alone = [html.extract(p, None)[0] for _, p in pages]
    assert alone[0] != want[0] and alone[1] != want[1] and alone[2] == want[2]


@pytest.mark.parametrize("part", ["<b>", "<p><b>", "<td><b><h1></i>", "</b><p>x<li>", "<div>"])
def test_large_pages_of_open_tags(part):
    page = "<p>Start " + part * ((1 << 18) // len(part)) + " end"
    tracemalloc.start()
    text = html.extract(page, None)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text.startswith("Start") and text.endswith("end") and peak < 50 << 20  # a quarter of a megabyte of tags


# 3 containment ----------------------------------------------------------


def test_containment_against_brute_force(spark):
    rng = random.Random(3)
    items = [prose(rng, n, 4000) for n in (7, 12, 20, 40, 60, 150)] + ["one two", "", None]
    texts = []
    for i in range(60):
        t = prose(rng, rng.choice([5, 60, 900]), 4000)
        item = (items[i % 6]).split()
        cut = item[: max(5, int(len(item) * rng.choice([0.7, 0.9, 1.0])))]
        at = rng.randrange(len(t) + 1)
        texts.append(t[:at] + " " + " ".join(cut).upper() + " " + t[at:] if i % 2 else t)
    texts += ["one two", "one two three", "", None, items[0]]
    item_df = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if grams(x) and 10 * len(grams(x) & grams(t)) >= 8 * len(grams(x))}
    for size in (1_000_000, 30):
        got = {(r["doc_id"], r["item_id"]) for r in contain.contained_items(docs(spark, texts), item_df, round_shingles=size).collect()}
        assert got == want
    assert contain.contained_items(docs(spark, texts), item_df.limit(0)).count() == 0
    assert contain.contained_items(docs(spark, []), item_df).count() == 0


# 4 shards ---------------------------------------------------------------


def test_difference_is_a_partition():
    rng = np.random.default_rng(4)
    v = np.zeros((300, 7), np.int64)
    v[:, 0] = rng.integers(1, 1000, 300)
    final, place = shards.difference(v)
    sums = np.zeros(7, np.int64)
    np.add.at(sums, place[:, 0], v[:, 0])
    assert sums.tolist() == final.tolist() and final.max() - final.min() <= 3
    assert all(sorted(p) == list(range(7)) for p in place.tolist())
    assert shards.difference(np.zeros((0, 3), np.int64))[0].tolist() == [0, 0, 0]


def test_difference_against_brute_force():
    """Karmarkar-Karp with explicit lists of members: the same spread rule, the first made first."""
    rng = random.Random(6)
    for _ in range(30):
        k, n = rng.choice([2, 3, 5]), rng.randrange(1, 40)
        weights = [rng.randrange(1, 60) for _ in range(n)]
        open_ = [(i, [(0, [])] * (k - 1) + [(w, [i])]) for i, w in enumerate(weights)]
        while len(open_) > 1:
            open_.sort(key=lambda x: (x[1][0][0] - x[1][-1][0], x[0]))
            (_, a), (_, b) = open_.pop(0), open_.pop(0)
            merged = sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, reversed(b), strict=True)), key=lambda x: x[0])
            open_.append((len(weights) + 1000 - len(open_), merged))
        v = np.zeros((n, k), np.int64)
        v[:, 0] = weights
        final, place = shards.difference(v)
        assert sorted(final.tolist()) == [x for x, _ in open_[0][1]]
        got = [sum(w for w, c in zip(weights, place[:, 0], strict=True) if c == j) for j in range(k)]
        assert got == final.tolist()


def test_shards(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 90)) for _ in range(400)] + ["same é"] * 30 + ["", None]
    df = docs(spark, texts)
    got = shards.balanced_shards(df, 5, groups_per_task=40).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    by = Counter()
    for r in got:
        t = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(t) + 8 and r["text_crc32"] == zlib.crc32(t)
        by[r["shard"]] += r["size"]
    assert max(by.values()) - min(by.values()) <= 400 and len(by) == 5
    assert len({r["shard"] for r in got if r["doc_id"] in range(400, 430)}) == 1 and len({r["shard"] for r in got if r["doc_id"] >= 430}) == 1
    for s in by:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert shards.balanced_shards(df.limit(0), 5).count() == 0


# 5 chat -----------------------------------------------------------------


def test_chat_round_trip(spark):
    rng = random.Random(6)
    bits = ["<|im_end|>", "<|im_start|>", "<|", "<\\|", "<\\\\|", "\\", "\n", "assistant\n", "hi", "é\U0001d4b3", "", "|>", "<", "$1"]
    rows = []
    for c in range(80):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", "sys\\n", "a\nb", "<|im_end|>", None]), None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(6)))))
    rows.append((None, 0, "user", "x"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    for c in {r[0] for r in rows}:
        want = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert got[c]["round_trip"] and [tuple(t) for t in got[c]["turns"]] == want
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_loss_runs(spark):
    df = spark.createDataFrame([(1, 0, "user", "u<|im_end|>x"), (1, 1, "assistant", "ok \U0001d4b3")], "conv_id long, turn long, role string, text string")
    r = chat.format_chats(df).withColumn("runs", chat.loss_runs(F.col("formatted"))).first()
    at, loss = 0, []
    for run in r["runs"]:
        at += run["skip"]
        loss += [r["formatted"][at : at + run["take"]]] if run["loss"] else []
        at += run["take"] + len(chat.END) + 1
    assert loss == ["ok \U0001d4b3"] and at == len(r["formatted"]) and r["n_escaped"] == 1


# 6 spans ----------------------------------------------------------------


def spans_by_hand(texts):
    def sentences(t):
        out, last = [], 0
        for m in re.finditer("[^\x20\x09-\x0d]+", t):
            nxt = re.compile("[^\x20\x09-\x0d]").search(t, m.end())
            if m[0][-1] in ".!?" or nxt is None or "\n" in t[m.end() : nxt.start()]:
                out.append((last, m.end()))
                last = m.end()
        return out

    first, places = {}, []
    for d, t in enumerate(texts):
        if t is None:
            continue
        s = [words_of(t[a:b]) for a, b in sentences(t)]
        for k, least in spans.RUNS:
            for i in range(len(s) - k + 1):
                run = tuple(map(tuple, s[i : i + k]))
                if sum(map(len, run)) >= least:
                    places.append((run, d, i, k))
                    first[run] = min(first.get(run, (d, i)), (d, i))
    gone = {d: set() for d in range(len(texts))}
    for run, d, i, k in places:
        if first[run] != (d, i):
            gone[d] |= set(range(i, i + k))
    return gone, [0 if t is None else len(sentences(t)) for t in texts]


def test_spans_against_brute_force(spark):
    rng = random.Random(7)
    pool = [prose(rng, rng.randrange(2, 14), 50) + rng.choice([".", "!", "\n"]) for _ in range(40)]
    passage = " ".join(pool[:6])
    texts = [" ".join(rng.choice(pool) for _ in range(8)) + (" " + passage if i % 3 == 0 else "") for i in range(40)] + [None, "", "  \n", passage, passage, prose(rng, 40) + ".", ""]
    gone, n = spans_by_hand(texts)
    got = {r["doc_id"]: r for r in spans.drop_repeated_spans(docs(spark, texts)).collect()}
    assert {d: r["n_removed"] for d, r in got.items()} == {d: len(g) for d, g in gone.items()}
    assert [got[d]["n_sentences"] for d in range(len(texts))] == n
    assert got[40]["text"] is None and got[41]["text"] == "" and got[0]["text"] == texts[0]
    last = got[44]
    assert last["n_removed"] == last["n_sentences"] and not last["text"].strip()
    assert spans.drop_repeated_spans(docs(spark, [])).count() == 0


def test_spans_of_short_lines(spark):
    rng = random.Random(70)
    menu = "\n".join(prose(rng, rng.randrange(1, 4), 4000) for _ in range(20)) + "\n"
    mixed = prose(rng, 45, 4000) + ".\nYes.\nno way\nOh.\n"
    short = "one.\ntwo three\nfour five.\n"
    own = lambda: prose(rng, 30, 4000) + ".\n"
    texts = [own() + (menu if i % 3 == 0 else mixed if i % 3 == 1 else short) + own() for i in range(30)] + [menu, mixed, "a\n" * 9, "a\n" * 9]
    got = {r["doc_id"]: r for r in spans.drop_repeated_spans(docs(spark, texts)).collect()}
    for i in range(3, 30):
        kept = got[i]["text"]
        assert got[i]["n_removed"] == (20, 4, 0)[i % 3] and (i % 3 == 2 or len(words_of(kept)) == 60)
    assert [got[i]["n_removed"] for i in (0, 1, 2, 30, 31, 32, 33)] == [0, 0, 0, 20, 4, 0, 0]


def test_short_runs_against_brute_force():
    rng = np.random.default_rng(71)
    words = rng.choice([1, 1, 1, 2, 3, 4, 9, 12], 3000)
    rows = np.unique(np.concatenate([[0, 3000], rng.integers(0, 3000, 300)]))
    got = [(k, i) for k, at, _ in spans._runs(np.arange(3000).astype(np.uint64), words, rows) for i in at.tolist() if k > 2]
    want = set()
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        for i in range(a, b - 2):
            want |= {(k, i) for k in [next((k for k in range(3, b - i + 1) if words[i : i + k].sum() >= 10), 0)] if k}
            e = b - (i - a)  # the end of a backward run
            want |= {(k, e - k) for k in [next((k for k in range(3, e - a + 1) if words[e - k : e].sum() >= 10), 0)] if k}
    assert len(got) == len(set(got)) and set(got) == want and 4 < max(k for k, _ in got) <= 10


# 7 quality --------------------------------------------------------------


def quality_by_hand(t):
    t = t or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(g)
    lines = [x for x in t.split("\n") if x.strip(SPACE)]
    covered = {j for i, x in enumerate(g) if c[x] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    rng = random.Random(8)
    texts = [prose(rng, n, v) for n in (0, 1, 2, 3, 5, 60, 400) for v in (2, 8, 300)] + ["a\na\n\n a\n \nb", "x x x x", "#$ %é\U0001d4b3 <>", None, "  ", prose(rng, 3000, 9), "a b c"]
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality.measure(docs(spark, texts)).collect()}
    assert got == {i: quality_by_hand(t) for i, t in enumerate(texts)}


def test_host_verdicts(spark):
    rng = random.Random(9)
    clean = [" ".join(f"word{rng.randrange(10**6)}" for _ in range(60)) for _ in range(120)]
    junk = [x.replace(" ", "*** ") for x in clean[:40]]
    texts = clean + junk[:39] + junk[39:] + ["short", None]
    sources = ["good"] * 60 + ["bad"] * 60 + ["bad"] * 39 + ["good"] + [None, "good"]
    got = {r["doc_id"]: r["kept"] for r in quality.host_quality(docs(spark, texts, sources)).collect()}
    assert all(got[i] for i in range(120)) and not any(got[i] for i in range(120, 159)) and got[159] and not got[160] and not got[161]
    assert quality.host_quality(docs(spark, [])).count() == 0


# 8 toxicity -------------------------------------------------------------


def test_toxicity_learns_words_and_ignores_the_held_out_fold(spark):
    rng = random.Random(10)
    texts, labels = [], []
    for i in range(900):
        w = prose(rng, 80).split()
        bad = rng.random() < 0.2
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["Idiotx,", "scumbagy", "moronz!"]))
        texts.append(" ".join(w))
        if rng.random() < 0.7:
            labels.append((i, int(bad)))
    texts += ["", None, "scumbagy"]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    df = docs(spark, texts)
    score = lambda rows: {r["doc_id"]: (r["held_out"], r["score"]) for r in toxicity.toxicity_scores(df, spark.createDataFrame(rows, "doc_id long, toxic int")).collect()}
    got = score(labels)
    test = [(i, t) for i, t in labels if held(i)]
    assert all(got[i][0] == held(i) for i in got) and sum((got[i][1] >= 0.5) == bool(t) for i, t in test) >= 0.97 * len(test)
    assert got[900][1] == got[901][1] < 0.5
    flipped = score([(i, 1 - t if held(i) else t) for i, t in labels])
    assert all(abs(flipped[i][1] - got[i][1]) < 1e-9 for i in got)
    assert all(s == (h, 1 / (1 + np.exp(50.0))) for h, s in [(v[0], v) for v in score([(0, 0)]).values()])


def test_nnpu_risk_does_not_overfit_the_unlabelled():
    rng = np.random.default_rng(1)
    pos = [np.append(0, rng.choice(np.arange(1, 50), 5, False)) for _ in range(100)]
    unl = [np.append(0, rng.choice(np.arange(1, 50), 5, False)) for _ in range(40)] + [rng.choice(np.arange(1, 50), 5, False) for _ in range(360)]
    w = toxicity.fit_nnpu(pos, unl, 50, 0.1)
    score = lambda rows: np.array([w[r].sum() + w[-1] for r in rows])
    assert (score(unl[:40]) > 0).mean() > 0.9 and (score(unl[40:]) > 0).mean() < 0.05


# 9 join -----------------------------------------------------------------


def classes_by_hand(texts):
    g = [grams(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if g[i] and g[j] and 100 * len(g[i] & g[j]) >= 80 * len(g[i] | g[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(g[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("bucket", [2, None])
def test_join_against_brute_force(spark, bucket):
    rng = random.Random(11)
    common = prose(rng, 60)
    texts = []
    for _ in range(12):
        base = prose(rng, rng.choice([3, 8, 40, 120])).split()
        for _ in range(rng.choice([1, 3, 9])):
            w = base[:]
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = "edit%d" % rng.randrange(50)
            texts.append(" ".join(w))
    texts += [common + " " + prose(rng, 90) for _ in range(25)] + ["", None, " \n", "one two", "One  TWO", "one two three", "one two"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(docs(spark, texts), bucket=bucket, group=4).collect()}
    assert got == classes_by_hand(texts)


def test_join_edge_cases(spark):
    assert jaccard.jaccard_classes(docs(spark, [])).count() == 0
    rows = [(None, "a b c d e f", 1), (5, "a b c d e f", 2), (5, "a b c d e f", 3), (2, "A b c d e f", 4)]
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect())
    assert got == [("2", "2"), ("5", "2"), ("5", "2"), ("None", "None")]


def test_tree_join_is_exact():
    rng = np.random.default_rng(12)
    for _ in range(60):
        x = np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64))
        sets = [np.unique(np.where(rng.random(len(x)) < 0.15, rng.integers(0, 60, len(x)), x).astype(np.uint64)) for _ in range(rng.integers(1, 12))]
        want = [i for i, s in enumerate(sets) if 5 * len(np.intersect1d(x, s)) >= 4 * len(np.union1d(x, s))]
        assert sorted(jaccard.tree_join(x, sets, 4, 5)) == want


def verdicts_by_hand(rows, z=1.645, limit=0.5):
    """kept by (host, hard failure, soft failures) rows, with exact sums."""
    hosts, out = {h for h, _, _ in rows}, {}
    n = {h: sum(x == h for x, _, _ in rows) for h in hosts}
    for r in ("symbols", "lines", "length", "any"):
        bad = [(h, bool(hard or soft) if r == "any" else r in soft) for h, hard, soft in rows]
        f = {h: sum(b for x, b in bad if x == h) for h in hosts}
        m = min(max(sum(f.values()) / len(rows), 1e-6), 1 - 1e-6)
        v = m * (1 - m)
        spread = sum(f[h] ** 2 / n[h] for h in hosts) - len(rows) * m * m
        between = (spread - v * (len(hosts) - 1)) / max(len(rows) - sum(x * x for x in n.values()) / len(rows), 1)
        k = max(v / max(between, v * 1e-4) - 1, 1)
        for h in hosts:
            rate = (f[h] + m * k) / (n[h] + k)
            out[h, r] = rate > limit if r == "any" else rate + z * (rate * (1 - rate) / (n[h] + k + 1)) ** 0.5 < m
    return [not hard and not out[h, "any"] and all(out[h, r] for r in soft) for h, hard, soft in rows]


def test_hosts_decide_documents(spark):
    rng = random.Random(10)
    clean = lambda: " ".join(f"word{rng.randrange(10**6)}" for _ in range(60))
    junk = lambda: clean().replace(" ", "*** ")
    rows = [("sound", junk)] + [("sound", clean)] * 220 + [("usual", junk)] * 18 + [("usual", clean)] * 60 + [("spam", junk)] * 70 + [("spam", clean)] * 10 + [("new", junk), (None, clean), (None, junk)]
    texts = [make() for _, make in rows] + ["short"] * 3
    hosts = [h for h, _ in rows] + ["sound", "usual", "spam"]
    got = {r["doc_id"]: r for r in quality.host_quality(docs(spark, texts, hosts)).collect()}
    failed = [{"symbols"} if "***" in t else set() for t in texts]
    want = verdicts_by_hand([(h, t == "short", f) for h, t, f in zip(hosts, texts, failed, strict=True)])
    assert [got[i]["kept"] for i in range(len(texts))] == want
    by = lambda host, bad: {w for w, h, f in zip(want[:-3], hosts, failed, strict=False) if h == host and bool(f) == bad}
    # Without the hosts, a document would stay just if it breaks no rule.
    assert by("sound", True) == {True} and by("usual", True) == {False} and by("usual", False) == {True} and by("spam", False) == {False} and by("new", True) == {False} and by(None, False) == {True}


# 10 pieces --------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("sentencepiece")
    try:
        return pieces.load_vocabulary()
    except OSError:
        pytest.skip("no vocabulary file here")


TEXTS = ["Hello  world\nfoo é 中 \U0001d4b3", " lead  two trailing  \n\n x ", "", "   ", "a", "ab", None, "the the the", "word " * 300]


def test_pieces_round_trip_and_distinct(spark, vocabulary):
    df = docs(spark, TEXTS)
    got = pieces.decode_pieces(pieces.sample_segmentations(df, k=4)).collect()
    for i, t in enumerate(TEXTS):
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["sample"])
        assert mine and all(r["decoded"] == (t or "") for r in mine)
        assert len({tuple(r["pieces"]) for r in mine}) == len(mine) and all(a["perturbed"] >= b["perturbed"] for a, b in zip(mine, mine[1:], strict=False))
        assert all(0 < r["inclusion"] <= 1 for r in mine)
    again = pieces.sample_segmentations(df.repartition(1), k=4).collect()
    assert sorted((r["doc_id"], r["sample"], tuple(r["pieces"])) for r in again) == sorted((r["doc_id"], r["sample"], tuple(r["pieces"])) for r in got)
    assert pieces.sample_segmentations(docs(spark, []), k=2).count() == 0


def test_pieces_tell_whether_they_decode_to_the_text(spark, vocabulary):
    texts = [*TEXTS, "7" * 300, "a ▁b"]
    got = pieces.sample_segmentations(docs(spark, texts), k=2).select("doc_id", "round_trip").collect()
    assert {r["doc_id"] for r in got} == set(range(len(texts)))
    assert all(r["round_trip"] == ("▁" not in (texts[r["doc_id"]] or "")) for r in got)


def test_pieces_tools_are_built_once_for_a_model(vocabulary):
    """A worker that has a model's tables takes no second copy from another query's broadcast, and they are small."""

    class Sent:
        value = vocabulary

    class Again:
        @property
        def value(self):
            raise AssertionError("read again")

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words"])], ["doc_id", "text"])
    one, two = (list(kernel.trimmed(pieces._sample(sent, vocabulary["digest"], 2, 1.0, pieces.BLOCK))(iter([batch]))) for sent in (Sent(), Again()))
    assert one == two
    lattices = pieces._tools(Again(), vocabulary["digest"], 1.0)[0]
    assert sum(x.nbytes for known in lattices.by_length.values() for x in known if isinstance(x, np.ndarray)) < 10e6


def test_pieces_follow_the_lattice_law(vocabulary):
    lattices = pieces.Lattices(vocabulary, 0.3)
    ids = {p.decode(): i for i, p in vocabulary["pieces"].items()}
    law = {}

    def walk(i, path, w, t="▁the"):
        if i == len(t):
            law[tuple(path)] = w
        for j in range(i + 1, len(t) + 1):
            if t[i:j] in ids:
                walk(j, [*path, ids[t[i:j]]], w + lattices.weight[ids[t[i:j]]])

    walk(0, [], 0.0)
    top = np.logaddexp.reduce(list(law.values()))
    law = {s: float(np.exp(w - top)) for s, w in law.items()}
    n = 6000
    data, offsets = kernel.buffers(pa.array(["the"] * n))
    got = pieces.sample_block(lattices, data, offsets, list(range(n)), 3)
    first, second = (Counter(tuple(x[r][0].tolist()) for x in got) for r in (0, 1))
    for s, p in law.items():
        q = sum(o * p / (1 - o) for t, o in law.items() if t != s)
        assert abs(first[s] / n - p) < 4 * (p / n) ** 0.5 + 1e-3 and abs(second[s] / n - q) < 4 * (q / n) ** 0.5 + 1e-3
    for x in got[:50]:
        assert all(abs(np.exp(lp) - law[tuple(p.tolist())]) < 1e-6 for p, lp, _, _ in x)
    assert abs(np.mean([sum(np.exp(lp) / inc for _, lp, _, inc in x) for x in got]) - 1) < 0.05


@pytest.mark.parametrize("start", ["7" * 300, "\n" * 170 + "7" * 200])
def test_pieces_leave_a_path_after_a_long_forced_start(vocabulary, start):
    lattices = pieces.Lattices(vocabulary, 0.3)
    ids = {p.decode(): i for i, p in vocabulary["pieces"].items()}
    byte = {i for i in vocabulary["byte"] if i >= 0}

    def paths(t):
        if not t:
            return [((), 0.0)]
        ends = [j for j in range(1, len(t) + 1) if t[:j] in ids]
        return [((ids[t[:j]], *p), w + lattices.weight[ids[t[:j]]]) for j in ends for p, w in paths(t[j:])]

    tail, n = paths("▁the"), 3000
    forced = pieces.sample_block(lattices, *kernel.buffers(pa.array([start])), [0], 2)
    assert len(forced[0]) == 1 and len(forced[0][0][0]) > 300 and (byte & set(forced[0][0][0].tolist()) or "\n" not in start)
    top = np.logaddexp.reduce([w for _, w in tail])
    law = {p: float(np.exp(w - top)) for p, w in tail}
    got = pieces.sample_block(lattices, *kernel.buffers(pa.array([start + " the"] * n)), list(range(n)), 2)
    k = len(forced[0][0][0])
    first, second = (Counter(tuple(x[r][0].tolist()[k:]) for x in got) for r in (0, 1))
    assert set(first) | set(second) <= set(law) and all(len(x) == 2 for x in got)
    for s, p in law.items():
        q = sum(o * p / (1 - o) for t, o in law.items() if t != s)
        assert abs(first[s] / n - p) < 4 * (p / n) ** 0.5 + 2e-3 and abs(second[s] / n - q) < 4 * (q / n) ** 0.5 + 2e-3
    assert abs(np.mean([sum(np.exp(lp) / inc for _, lp, _, inc in x) for x in got]) - 1) < 0.05
    prose = pieces.sample_block(lattices, *kernel.buffers(pa.array([start + " and then some more words"])), [1], 4)[0]
    assert len({tuple(p.tolist()) for p, _, _, _ in prose}) == 4 and all(0 < i <= 1 for _, _, _, i in prose)


def test_digests_are_stable():
    data, offsets = kernel.buffers(pa.array(["Some text. More text!", "x"]))
    h, _, _ = kernel.word_hashes(data, offsets)
    assert hashlib.sha256(h.tobytes()).hexdigest()[:8] == hashlib.sha256(kernel.word_hashes(data.copy(), offsets.copy())[0].tobytes()).hexdigest()[:8]
