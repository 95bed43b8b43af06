"""KD-trees, decontamination, HTML and the pipeline."""

import numpy as np
import pytest

import corpus_pipeline
from mercato.llm import decontaminate, html_extract, kdtree
from mercato.llm.queries import op4_decontamination, op6_top_k, op8_html
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def plain_top(rows, k=5):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(ok):
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for m, (j, w) in enumerate(ok) if m != n and len(w) == len(v))[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in df.collect())


def test_top_k_equals_brute_force(llm):
    rows = [(r.vec_id, r.embedding) for r in llm.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert got(op6_top_k(llm, SMALL)) == plain_top(rows)


@pytest.mark.parametrize(("cell", "piece", "block"), [(40, 1000, 1000), (10, 7, 2), (1000, 30, 1)])
def test_top_k_odd_rows(llm, folder, monkeypatch, cell, piece, block):
    """Few and many cells, cells cut into pieces (the repeated vector's is), queries cut into blocks."""
    for name, value in (("CELL", cell), ("PIECE", piece), ("BLOCK", block), ("LEAF", 8)):
        monkeypatch.setattr(kdtree, name, value)
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(-3, 4, 4).astype(float).tolist()) for i in range(150)]
    rows += [(i, [1.0, 2.0, -1.0, 0.5]) for i in range(150, 260)]  # one vector many times: ties
    rows += [(50, rows[50][1]), (50, [3.0] * 4), (None, [1.0] * 4), (300, None), (301, [1.0, None, 2.0, 3.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (350, []), (400, [1.0, 2.0]), (401, [2.0, 2.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("part", F.lit(1))
    assert got(op6_top_k(llm, folder(embeddings=df))) == plain_top(rows)
    assert op6_top_k(llm, folder(embeddings=df.limit(0))).count() == 0


def test_cells_and_bounds_prune_on_clustered_vectors(llm, monkeypatch):
    """Copies of queries and visited points stay well under all of them; uniform
    vectors in many dimensions can't be pruned by any box and stay exact."""
    monkeypatch.setattr(kdtree, "CELL", 64)
    draw = np.random.default_rng(6)
    centres = draw.normal(0, 1, (40, 16)) * 3
    rows = [(i, (centres[i % 40] + draw.normal(0, 0.15, 16)).tolist()) for i in range(4000)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(kdtree.top_k(df)) == plain_top(rows)
    dealt = kdtree.deal(kdtree.usable(df, "vec_id", "embedding"), kdtree.choose_cells(kdtree.usable(df, "vec_id", "embedding"), len(rows)))
    cells = dealt.select("cell").distinct().count()
    found = kdtree.all_candidates(df, 50, 5).groupBy("rid").count()
    met = found.agg(F.sum("count")).first()[0] / (80 * 5)     # pieces that held candidates of a query
    assert cells > 30 and met < 0.25 * cells
    box = kdtree.boxes(dealt)[16]
    sizes = {r.cell: r["count"] for r in dealt.groupBy("cell").count().collect()}
    best = {}
    for q, _, _, score in got(kdtree.top_k(df)):
        best[q] = min(score, best.get(q, score))
    vectors = np.floor(256 * np.array([v for i, v in rows if i % 50 == 0]))
    reached = kdtree.box_bounds(vectors, box[1], box[2]) >= np.array([best[i] for i, _ in rows if i % 50 == 0])[:, None]
    share = (reached * np.array([sizes[c] for c in box[0].tolist()])).sum() / (len(vectors) * len(rows))
    assert share < 0.3, share


def test_cells_part_points_and_ties():
    draw = np.random.default_rng(4)
    for points in (draw.normal(0, 1, (1000, 5)), np.ones((50, 3)), np.zeros((0, 3)), np.repeat([[0.0, 1.0], [0.0, 2.0]], [90, 10], 0)):
        cells = kdtree.Cells(points, 4)
        of = cells.of(points)
        assert ((of >= 0) & (of < 16)).all()
        if len(points) == 1000:
            assert np.bincount(of, minlength=16).min() > 40
        if points.shape == (100, 2):
            assert len(np.unique(of)) == 2


def test_bounds_hold_for_every_point():
    draw = np.random.default_rng(4)
    tree = kdtree.Tree(np.arange(500), draw.integers(-50, 50, (500, 6)).astype(float), 8)
    queries = draw.integers(-50, 50, (5, 6)).astype(float)
    for bound, (b, e) in zip(tree.bounds(queries).T, tree.span, strict=True):
        assert (tree.points[b:e] @ queries.T <= bound).all()


ITEM = "A train leaves with 30 wagons and travels 120 km to meet Anna before it turns back to the old station near the river."
MOVED = "A train leaves with 45 wagons and travels 300 km to meet Boris before it turns back to the old station near the river."
MIXED = "One box holds 3 pens and 3 caps so that both kinds match in number on each table of the long hall."
BROKEN = "One box holds 8 pens and 9 caps so that both kinds match in number on each table of the long hall."


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_WINDOWS, 0])
def test_templates_and_slots(llm, make_docs, most):
    items = llm.createDataFrame([(1, ITEM), (2, MIXED), (3, "too short"), (4, None), (5, "")], "item_id long, text string")
    docs = make_docs([f"Some text first. {ITEM} And more.", f"Some text first. {MOVED} And more.", f"x y. {BROKEN} z.", "nothing of that kind", None, "", "it was too short", MIXED], [0, 1, 2, 3, None, 5, 6, 7]).withColumn("key", F.lit(1))
    rows = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, items, most_broadcast=most).collect()}
    assert {k for k, r in rows.items() if r.contaminated} == {(0, 1), (1, 1), (6, 3), (7, 2)}
    assert rows[0, 1].changed == 0 and rows[1, 1].changed == 3 and rows[1, 1].consistent and not rows[2, 2].consistent
    kept = decontaminate.without_leaks(docs, items, most_broadcast=most)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "5", "None"] and kept.columns == docs.columns
    assert decontaminate.find_leaks(make_docs([]), items).count() == 0 and decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def marked(llm, make_docs, item, docs, **options):
    """Which of ``docs`` count as contaminated by ``item``, both ways of joining."""
    items = llm.createDataFrame([(1, item)], "item_id long, text string")
    out = [sorted(r.doc_id for r in decontaminate.find_leaks(make_docs(docs), items, most_broadcast=most).where("contaminated").collect()) for most in (decontaminate.BROADCAST_WINDOWS, 0)]
    assert out[0] == out[1]
    return out[0]


def test_shifted_copies(llm, make_docs):
    """Words added and left out, and values of another number of words."""
    words = ITEM.split()
    docs = [" ".join(["x.", *words[:8], "really", *words[8:16], "quite", *words[16:]]), " ".join([*words[:8], *words[9:14], *words[15:]]),
            ITEM.replace("30", "twenty five").replace("Anna", "Boris Ivan"), ITEM.replace("120", "two hundred").replace("30", "forty one"), " ".join(words[:8])]
    assert marked(llm, make_docs, ITEM, docs) == [0, 1, 2, 3]
    place = "In New York there are 20 shops and a few large halls where people from Boston buy their bread and milk."
    assert marked(llm, make_docs, place, [place.replace("New York", "Rome").replace("Boston", "Los Angeles").replace("20", "thirty five")]) == [0]


def test_copies_with_one_value_changed(llm, make_docs):
    names = "On the way home Anna met an old friend and later that day Anna wrote a long letter to the whole family."
    numbers = "A box holds 5 red pens and also 5 blue caps so that both kinds match in number on each table."
    assert marked(llm, make_docs, names, [names.replace("later that day Anna", "later that day Ana")]) == [0]
    assert marked(llm, make_docs, numbers, [numbers.replace("5 blue", "6 blue"), numbers.replace("5 blue", "6 blue").replace("5 red", "8 red")]) == [0]


def test_dense_and_lower_case_shapes(llm, make_docs):
    tom = "Tom has 5 apples. Tom buys 3 more. Tom eats 2."
    assert marked(llm, make_docs, tom, [tom.replace("Tom", "Sam"), tom.replace("Tom", "Sam").replace("5", "9").replace("3", "4").replace("2", "6"), tom.lower(), tom.upper(), "Tom has 5 pears."]) == [0, 1, 2, 3]
    dense = "Add 4, 8, 15, 16, 23, 42 and then subtract 7, 9, 11, 13 from the total that came out"
    assert marked(llm, make_docs, dense, [dense.replace("15", "18").replace("9", "6"), dense.lower()]) == [0, 1]
    people = "Anna met Boris in Rome and Clara met David in Paris before Emil saw them all near the river"
    assert marked(llm, make_docs, people, [people.lower(), people.replace("Boris", "Igor").replace("Rome", "Oslo").replace("Emil", "Otto")]) == [0, 1]
    first = "Trains leave the old station at 7 and reach the far end of the valley at 9 each day"
    assert marked(llm, make_docs, first, ["we saw that " + first.lower().replace("7", "8").replace("9", "10")]) == [0]
    short = "Anna Maria has five red apples and pears"
    assert marked(llm, make_docs, short, [short.replace("Anna Maria", "Otto").replace("five", "twenty two")]) == [0]


def test_short_items_need_more_evidence(llm, make_docs):
    assert marked(llm, make_docs, "Yes.", ["Yes, they said, and yes again.", "yes"]) == [1]
    assert marked(llm, make_docs, "12", ["At 12 they had 12 of 12 cups.", "twelve"]) == []
    assert marked(llm, make_docs, "Tom has 5 apples", ["Here Sam has 7 apples left.", "Here Tom has 5 apples left."]) == [1]
    item = "When Anna had 5 of 9 cups and Otto 7, they went to the lake to swim."  # 16 words
    assert marked(llm, make_docs, item, ["When Igor had 6 of 8 cups and nothing else came.", item.replace("5", "6").replace("Otto", "Emil")]) == [1]
    items = llm.createDataFrame([(1, "12")], "item_id long, text string")
    rows = decontaminate.find_leaks(make_docs(["12 12 12 " * 300, "none"]), items).collect()
    assert [(r.doc_id, r.windows, r.contaminated) for r in rows] == [(0, 1, False)]


def test_every_copied_item_is_found(llm):
    sf = "/root/testdata/sf0.01"
    items = {r.item_id: r.text for r in llm.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(d.doc_id, i) for d in llm.read.parquet(f"{sf}/documents.parquet").collect() for i, t in items.items() if t in d.text}
    assert want <= {(r.doc_id, r.item_id) for r in op4_decontamination(llm, sf).where("contaminated").collect()}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="x">
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu, one.</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice"><p>We use cookies, please.</p></div>
<div class="ad">Buy, buy, buy.</div><article><h1>Title &amp; more</h1><p><b>First   para,\n with &lt;tags&gt;.<br><p>Ti.</p><p>Third&nbsp;one &#233;.<aside>Side, note.</aside>
<form><label>Name</label><input name=q></form><div>Deep <i>text</i>, here.</div><ul><li>one<li>two</ul><div class="comments"><p>I disagree, sir.</p></div></article>
<div id="sidebar"><p>More, more, more.</p></div><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html_extract.main_text(PAGE) == "Title & more\nFirst para, with <tags>.\nTi.\nThird one é.\nDeep text, here.\none\ntwo"
    for odd in (None, "", "   ", "<", "<p", "</p></div>", "<!-- open", "<script>x", "<div a='>"):
        assert "\n\n" not in html_extract.main_text(odd)
    assert html_extract.main_text("<body><div><p>Alone, but long enough.</p><p>Two.</p></div>") == "Alone, but long enough.\nTwo."


PROSE = [f"Paragraph {i} has some words, and then it goes on for a while; this is how prose of an article reads, sentence {i} after sentence." for i in range(12)]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in PROSE)
AROUND = '<div class="sidebar"><ul><li><a href="/a">Other, page</a></li></ul></div><div id="comments"><p>I disagree, sir.</p></div><div class="cookie-notice"><p>We use cookies.</p></div>'


@pytest.mark.parametrize(("begin", "end"), [
    ('<div class="layout has-sidebar"><article>', "</article></div>"), ('<div id="page" class="with-header"><article>', "</article></div>"), ('<article class="post comments-open">', "</article>"),
    ('<div class="sidebar"><div class="text">', "</div></div>"), ('<form id="form"><main class="header">', "</main></form>"), ('<div role="dialog"><div>', "</div></div>"), ('<span class="widget"><div>', "</div></span>")])
def test_wrappers_with_listed_names_keep_the_article(begin, end):
    assert html_extract.main_text(f"<body>{AROUND if 'sidebar' not in begin else ''}{begin}{PARAGRAPHS}{end}</body>") == "\n".join(PROSE)


def test_sections_with_listed_names_and_formulas():
    page = f'<body>{AROUND}<article>{PARAGRAPHS}<div class="related-work"><p>Others did it, too.</p></div><section id="discussion"><h2>Discussion</h2><p>{PROSE[0]}</p></section>' \
           f'<p>As <math><mi>a</mi><mo>=</mo><mn>2</mn></math> <span class="share">Share!</span>shows.</p><div class="comments"><p>{PROSE[1]}</p></div></article></body>'
    assert html_extract.main_text(page) == "\n".join([*PROSE, "Others did it, too.", "Discussion", PROSE[0], "As a=2 shows."])


def test_ratios_choose_nodes_of_several_sections():
    lead = "A lead of some length, with a comma; it tells what the text is about, and why one might want to read all of it now."
    links = '<div class="x"><a href="/1">One</a> <a href="/2">Two</a></div>'
    page = f"<body><div class='top'>Site</div><div id='content'><h1>Title</h1><div class='intro'><p>{lead}</p></div>{links}<div class='body'>{PARAGRAPHS}</div><div class='more'><h2>End</h2><ul><li>a<li>b</ul><p>{lead}</p></div></div>{links}</body>"
    assert html_extract.main_text(page) == "\n".join(["Title", lead, *PROSE, "End", "a", "b", lead])
    page = f"<body><div>Site</div><main><h1>Title</h1><p>{lead}</p><article class='one'>{PARAGRAPHS}</article><article class='two'><h2>More</h2><p>{lead}</p></article>{links}</main><div>Imprint</div></body>"
    assert html_extract.main_text(page) == "\n".join(["Title", lead, *PROSE, "More", lead])
    page = f"<body><section><p>{lead}</p></section><section><pre>{'code(x, y); ' * 5000}</pre></section><section><h2>After</h2><p>{lead}</p></section></body>"
    assert html_extract.main_text(page) == "\n".join([lead, ("code(x, y); " * 5000).strip(), "After", lead])


def test_pages_query(llm, folder):
    rows = op8_html(llm, SMALL).collect()
    assert len(rows) == llm.read.parquet(f"{SMALL}/pages.parquet").count() and all(r.n_chars == len(r.text) for r in rows) and any(r.text for r in rows)
    odd = llm.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, "v", "<p>a " * 50_000, "x")], "page_id long, url string, html string, text string")
    assert op8_html(llm, folder(pages=odd)).count() == 5 and op8_html(llm, folder(pages=odd.limit(0))).count() == 0


def test_one_row_of_each_component(llm, make_docs):
    """Unlike texts that share an id stay, rows without ids are deduplicated, too."""
    draw = np.random.default_rng(8)
    a, b, c, d, e = (" ".join(f"w{n}" for n in draw.integers(0, 10_000, 80)) for _ in range(5))
    docs = make_docs([a, b, b, c, c, a, d, d, e, e], [5, 5, 3, None, None, None, 9, 9, None, 4])
    rows = corpus_pipeline.drop_near_duplicates(llm, docs, SMALL).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == sorted([("5", a), ("3", b), ("None", c), ("9", d), ("4", e)])
    both = corpus_pipeline.drop_near_duplicates(llm, make_docs([a, b], [5, 5]), SMALL).collect()
    assert sorted(r.text for r in both) == sorted([a, b])


def test_pipeline_stages(llm):
    """Every stage against its own input; the chain equals the stages in turn."""
    from test_byte_bpe import expected, library
    from test_simhash import plain_components, plain_fingerprint
    from test_suffix_dedup import plain

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "byte_level_bpe"]
    docs, columns = llm.read.parquet(f"{SMALL}/documents.parquet"), corpus_pipeline.COLUMNS
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(llm, frames[-1], SMALL).cache())
    before, calm, single, cut, clean, coded = (f.collect() for f in frames)
    assert all(f.columns == columns for f in frames[:-1])
    assert {r.doc_id for r in calm} <= {r.doc_id for r in before} and len(calm) > len(before) // 2
    ids = [r.doc_id for r in calm]
    classes = plain_components(ids, [plain_fingerprint(r.text) for r in calm], 3)
    assert sorted(r.doc_id for r in single) == sorted(set(classes))
    lengths = {r.doc_id: w[0] - w[1] for r, w in zip(single, plain([r.text for r in single]), strict=True)}
    assert all(lengths[r.doc_id] - 6 <= len(r.text.encode()) <= lengths[r.doc_id] and r.n_chars == len(r.text) for r in cut) and len(cut) == len(single)
    items = [r.text for r in llm.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not any(t in r.text for r in clean for t in items) and len(clean) >= len(cut) * 0.9
    enc = library()
    text = {r.doc_id: r.text for r in clean}
    assert {(r.doc_id, (r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in coded} == {(i, expected(t, enc)) for i, t in text.items()}
    assert sorted(map(tuple, corpus_pipeline.run(llm, SMALL).collect())) == sorted(map(tuple, coded))
