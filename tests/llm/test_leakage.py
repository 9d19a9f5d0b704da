import random

from plumbline.llm.leakage import leaked_passages, positional_index, tokens

RNG = random.Random(8)
WORDS = [a + b + c for a in ("ba", "ko", "mi", "tu") for b in ("re", "lo", "na") for c in ("s", "t", "nd")]
HEAD = "Read the scene below and answer briefly."


def sentence(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


ITEMS = [(i, f"{HEAD} {sentence(40)}." if i % 2 else sentence(40)) for i in range(12)] + [(50, "".join(chr(0x4E00 + RNG.randrange(3000)) for _ in range(60))), (51, None), (52, "")]


def brute(docs):
    """Longest stretch at any offset with at most two changed words, told from the item's own words."""
    found = set()
    head = tokens(HEAD)
    for d, text in docs:
        doc = tokens(text or "")
        for i, item in ITEMS:
            own = tokens(item or "")
            own = own[len(head) :] if own[: len(head)] == head else own
            need = 22 if i == 50 else 14
            for shift in range(-len(own), len(doc)):
                same = [0 <= shift + k < len(doc) and doc[shift + k] == w for k, w in enumerate(own)]
                for a in range(len(own)):
                    for b in range(a + need, len(own) + 1):
                        if same[a] and same[b - 1] and same[a:b].count(False) <= 2:
                            found.add((d, i))
    return found


def search(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item", "2 as body", "3 as length")
    items = spark.createDataFrame(ITEMS, "item_id long, item_text string").selectExpr("*", "'x' as head", "1 as block")
    return leaked_passages(df, "doc_id", "text", items, "item_id", "item_text", **options)


def changed(words, places):
    return [("zzz" if k in places else w) for k, w in enumerate(words)]


def test_hits_equal_brute_force(spark):
    own = [t.split(". ", 1)[-1].rstrip(".").split() for _, t in ITEMS[:12]]
    docs = [(100 + k, f"{sentence(15)} {' '.join(changed(own[k % 12][k : k + n], set(RNG.sample(range(n), c))))} {sentence(9)}") for k, (n, c) in enumerate([(14, 0), (13, 0), (20, 2), (20, 3), (14, 1), (16, 2), (30, 2), (12, 0), (17, 1), (25, 4)])]
    docs += [(200, HEAD + " " + sentence(10)), (201, None), (202, ""), (203, ITEMS[1][1]), (203_1, ITEMS[1][1])]
    got = search(spark, docs).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs) and len(got) == len({(r.doc_id, r.item_id) for r in got})
    blocks = search(spark, docs, block_tokens=100).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))


def test_disguises(spark):
    words = ITEMS[0][1].split()[:16]
    text = "&nbsp; ".join([" ".join(words[:5]).upper(), "<b>" + ", ".join(words[5:10]) + "</b>", f"**{words[10]}** - " + " ".join(words[11:])])
    chinese = ITEMS[12][1]
    got = {(r.doc_id, r.item_id, r.kind) for r in search(spark, [(1, text), (2, "前言" + "，".join(chinese[:24])), (3, chinese[:21]), (4, chinese[:15] + "改动" + chinese[17:30])]).collect()}
    assert got == {(1, 0, "exact"), (2, 50, "exact"), (4, 50, "near")}


def test_long_document_and_no_items(spark):
    long = sentence(60_000) + " " + " ".join(ITEMS[2][1].split()[3:20])
    assert [(r.doc_id, r.item_id) for r in search(spark, [(1, long)]).collect()] == [(1, 2)]
    docs, items = spark.createDataFrame([(1, long)], "doc_id long, text string"), spark.createDataFrame([], "item_id long, item_text string")
    assert leaked_passages(docs, "doc_id", "text", items, "item_id", "item_text").count() == 0
    assert leaked_passages(docs.limit(0), "doc_id", "text", spark.createDataFrame(ITEMS, items.schema), "item_id", "item_text").count() == 0


def test_left_out_and_put_in_words(spark):
    docs, wanted = [], set()
    for d in range(400):
        i = d % 12
        own = ITEMS[i][1].split(". ", 1)[-1].rstrip(".").split()
        a = RNG.randrange(0, 20)
        part = own[a : a + RNG.randrange(16, 21)]
        for k, at in enumerate(RNG.sample(range(3, len(part) - 3), RNG.randrange(0, 3))):
            kind = RNG.choice(("put", "leave", "swap", "two"))
            part[at] = {"put": f"{part[at]} qqq{k}", "leave": "", "swap": "qqq", "two": "qq-rr"}[kind]
        docs.append((d, f"{sentence(20)} {' '.join(part)} {sentence(20)}"))
        wanted.add((d, i))
    got = {(r.doc_id, r.item_id) for r in search(spark, docs).collect()}
    assert len(wanted & got) >= 0.99 * len(wanted) and not got - wanted


def test_index_holds_every_token_at_its_place(spark):
    texts = [(1, "One two, one."), (2, ""), (3, "two 雾港 two"), (4, None)]
    rows = positional_index(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), "doc_id", "text").collect()
    papers = [r for r in rows if r.token is None]
    assert [list(zip(r.docs, r.gaps)) for r in papers] == [[(1, 3), (2, 0), (3, 4), (4, 0)]]
    places = {r.token: [sum(r.gaps[: k + 1]) for k in range(r.n)] for r in rows if r.token is not None}
    assert places == {"one": [0, 2], "two": [1, 19, 22], "雾": [20], "港": [21]}


def test_pieces_of_long_items_and_heads_after_blanks(spark, monkeypatch):
    import plumbline.llm.leakage as leakage

    monkeypatch.setattr(leakage, "PIECE", 100)
    body = [sentence(30) for _ in range(5)]
    items = spark.createDataFrame([(k, f"\n {HEAD}\n{b}") for k, b in enumerate(body)] + [(9, sentence(400))], "item_id long, item_text string")
    long = items.where("item_id = 9").first().item_text.split()
    docs = spark.createDataFrame([(k, b) for k, b in enumerate(body)] + [(7, f"{HEAD} {sentence(9)}"), (8, " ".join(long[150:190]))], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.length, r.start) for r in leaked_passages(docs, "doc_id", "text", items, "item_id", "item_text").collect()}
    assert set(got) == {(k, k) for k in range(5)} | {(8, 9)}
    assert got[8, 9] == (40, 150)
