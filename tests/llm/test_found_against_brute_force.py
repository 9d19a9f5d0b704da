"""The p-queries without SQL, held against other ways to the same rows on the smaller tables."""

import re

import numpy as np
from oracles import connection

from plumbline.llm.leakage import WIDE, tokens
from plumbline.llm.queries import queries
from plumbline.llm.reading import fit_reading, reading_grades

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
Q = queries()

VOTES = """
WITH finished AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dt DESC) AS place FROM eval_tasks) WHERE place = 1 AND status = 12
),
entries AS (
  SELECT content_id, eval_session_id, (e ->> '$.winner_id')::BIGINT AS winner_id, e ->> '$.eval_dim_key' AS dim
  FROM finished, unnest(CASE WHEN json_valid(result) THEN json_extract(result, '$[*]') ELSE [] END) AS u(e)
),
pairs AS (SELECT DISTINCT ON (id) * FROM eval_comparisons ORDER BY id, dt DESC),
made AS (SELECT id, llm_model_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS place FROM llm_answers) WHERE place = 1),
votes AS (
  SELECT e.*, answer_left, answer_right, coalesce(is_golden, 0) AS golden FROM entries e JOIN pairs p ON p.id = e.content_id
  WHERE winner_id IS NOT NULL AND winner_id IN (0, answer_left, answer_right)
)"""


def test_p3_ranks_are_those_of_the_solved_chain(spark):
    """The chain's balance is solved as a linear system from counts by SQL."""
    rows = connection(MEDIUM).sql(f"""{VOTES}
        SELECT dim, l.llm_model_id AS a, r.llm_model_id AS b, sum(CASE winner_id WHEN answer_left THEN 1 WHEN 0 THEN 0.5 ELSE 0 END)::DOUBLE AS won, count(*) AS n
        FROM votes JOIN made l ON l.id = answer_left JOIN made r ON r.id = answer_right WHERE golden = 0 AND l.llm_model_id <> r.llm_model_id GROUP BY ALL""").df()
    got = {(r.eval_dim_key, r.llm_model_id): r.rank_no for r in Q["p3_found"](spark, MEDIUM).collect()}
    for dim, part in rows.groupby("dim"):
        models = sorted({*part.a, *part.b})
        won, met = np.zeros((2, len(models), len(models)))
        for r in part.itertuples():
            i, j = models.index(r.a), models.index(r.b)
            won[i, j] += r.won
            won[j, i] += r.n - r.won
            met[i, j] += r.n
            met[j, i] += r.n
        rates = np.where(met > 0, (met - won + 1) / (met + 2), 0)
        balance = (rates - np.diag(rates.sum(1))).T
        balance[0] = 1
        p = np.linalg.solve(balance, np.eye(len(models))[0])
        assert [got[dim, models[i]] for i in np.argsort(-p)] == list(range(1, len(models) + 1))


def test_p1_users_name_the_majority_less_often(spark):
    """Majorities by SQL are a plainer consensus: found users lie below the others by them too, but for a few near the border."""
    rows = connection(MEDIUM).sql(f"""{VOTES},
        people AS (SELECT id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dt DESC) AS place FROM eval_sessions) WHERE place = 1 AND user_id IS NOT NULL),
        v AS (SELECT * FROM votes JOIN people ON id = eval_session_id WHERE golden = 0),
        best AS (SELECT content_id, dim, winner_id FROM v GROUP BY content_id, dim, winner_id QUALIFY row_number() OVER (PARTITION BY content_id, dim ORDER BY count(*) DESC, winner_id) = 1)
        SELECT user_id, count(*) AS n, avg((v.winner_id = best.winner_id)::INT) AS share FROM v JOIN best USING (content_id, dim) GROUP BY user_id HAVING count(*) >= 30""").df()
    found = {r.user_id for r in Q["p1_found"](spark, MEDIUM).collect()}
    assert found <= set(rows.user_id) and 0 < len(found) < len(rows)
    inside, outside = rows[rows.user_id.isin(found)].share, rows[~rows.user_id.isin(found)].share
    border = (inside.median() + outside.median()) / 2
    assert (inside < border).mean() > 0.9 and (outside > border).mean() > 0.9


def test_p5_empty_and_copied_answers(spark):
    """Both types by SQL on the bare letters and digits."""
    bare = lambda c: f"""regexp_replace(lower(regexp_replace(translate({c}, '？！，。：；（）＝', '?!,.:;()='), '<[^<>]*>|&[a-z]+;', ' ', 'g')), '[^\\p{{L}}\\p{{N}}]', '', 'g')"""
    rows = connection(SMALL).sql(f"""
        WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY answer_id ORDER BY generated_at DESC) AS place FROM llm_answer) WHERE place = 1),
        q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item) WHERE place = 1)
        SELECT answer_id, {bare("coalesce(answer_content, '')")} AS told, {bare("raw_query")} AS asked FROM a LEFT JOIN q USING (query_id)""").df()
    got = {r.answer_id: r.defect for r in Q["p5_found"](spark, SMALL).collect()}
    blank = {r.answer_id for r in rows.itertuples() if r.told in ("", "null", "none", "na", "nan")}
    assert {k for k, v in got.items() if v == "empty"} == blank
    same = {r.answer_id for r in rows.itertuples() if r.asked and r.told == r.asked}
    assert same and same <= {k for k, v in got.items() if v == "copied_question"}


def test_p8_exact_passages(spark):
    """Every run of 14 words (22 Chinese characters) of an item's text that a document repeats."""
    con = connection(SMALL)
    docs, items = con.sql("SELECT doc_id, text FROM documents WHERE text IS NOT NULL").fetchall(), con.sql("SELECT item_id, item_text FROM heldout_items").fetchall()
    heads = {}
    for _, t in items:
        head = re.split(r"(?<=[.。：:])", t, maxsplit=1)[0]
        heads[head] = heads.get(head, 0) + 1
    runs = {}
    for i, t in items:
        head = re.split(r"(?<=[.。：:])", t, maxsplit=1)[0]
        own = tokens(t[len(head) :] if heads[head] > 2 else t)
        n = 22 if sum(bool(WIDE.match(w)) for w in own) > len(own) / 2 else 14
        for k in range(len(own) - n + 1):
            runs.setdefault(tuple(own[k : k + n]), set()).add(i)
    wanted = set()
    for d, t in docs:
        words = tokens(t)
        for n in (14, 22):
            for k in range(len(words) - n + 1):
                wanted |= {(d, i) for i in runs.get(tuple(words[k : k + n]), ())}
    rows = Q["p8_leaks"](spark, SMALL).collect()
    assert wanted and wanted <= {(r.doc_id, r.item_id) for r in rows}
    assert {(r.doc_id, r.item_id) for r in rows if r.kind == "exact"} <= wanted


def test_p10_grades_of_documents_left_out(spark):
    """Fitted without a third of the labelled documents, whose grades are then told; labels err by one grade at times."""
    documents, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "reading_labels"))
    kept = labels.where("xxhash64(doc_id) % 3 != 0")
    model = fit_reading(documents, "doc_id", "text", kept, "grade")
    left = labels.where("xxhash64(doc_id) % 3 = 0").groupBy("doc_id").agg({"grade": "median"}).toDF("doc_id", "label")
    rows = reading_grades(documents.join(left, "doc_id", "left_semi"), "doc_id", "text", model).join(left, "doc_id").where("grade is not null").collect()
    near = [abs(r.grade - r.label) for r in rows]
    assert len(near) >= 20 and np.mean([x < 1 for x in near]) > 0.8 and np.mean([x <= 1 for x in near]) > 0.95
