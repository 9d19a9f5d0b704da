import pytest

from plumbline.llm.defects import answer_defects, defects_of
from plumbline.llm.languages import Profiles, fit_profiles, language, script

Q = "How do I beat Gorofima with 12 potions?"
CASES = [
    (None, Q, ["empty"]),
    ("", Q, ["empty"]),
    (" 　\n", Q, ["empty"]),
    ("<p></p>", Q, ["empty"]),
    ("**  **", Q, ["empty"]),
    ("N/A", Q, ["empty"]),
    ("null", None, ["empty"]),
    ("Bring at least 12 charges, because Gorofima heals.", Q, []),
    ("About 42 days.", Q, []),
    ("No, Gorofima cannot drop there.", Q, []),
    ("I can't recommend rushing Gorofima early, but the following works. Keep the keys.", Q, []),
    ("You cannot help the guard, so do this instead. Go left.", Q, []),
    ("Sorry for the long text, here is the plan. Start at the mill. Then go on.", Q, []),
    ("I'm sorry, but I can't help with that.", Q, ["refusal"]),
    ("Unfortunately, this request goes against my guidelines, so I won't be able to continue.", Q, ["refusal"]),
    ("抱歉，我无法回答这个问题。", "怎么打赢这个首领？", ["refusal"]),
    ("Lo siento, no puedo ayudarte con eso. Puedes preguntar otra cosa.", "Cómo derroto a Gorofima con pociones?", ["refusal"]),
    ("Leider darüber möchte ich nicht sprechen.", "Wie besiege ich Gorofima mit Tränken?", ["refusal"]),
    (Q, Q, ["copied_question"]),
    ("Question: how do I beat Gorofima with 12 potions?", Q, ["copied_question"]),
    (Q + "\nBring at least 12 charges, because it heals.", Q, []),
    ("Die Chance liegt bei etwa 31 Prozent, also plane mehrere Läufe ein.", Q, ["wrong_language"]),
    ("单人大概3分钟，带治疗能省一半。", Q, ["wrong_language"]),
    ("Bring at least 12 charges, because it heals. As players say: “Wer wagt, gewinnt”.", Q, []),
    ("单人大概3分钟，带治疗能省一半。", '{"game": "Tide", "target": "x", "ask": "装备替换"}', []),
    ("Bring at least 12 charges, because it", Q, ["truncated"]),
    ("1. Bring charges.\n2. Keep the keys.\n3.", Q, ["truncated"]),
    ("Bring (at least 12 charges.", Q, ["truncated"]),
    ("```\nBring charges.", Q, ["truncated"]),
    ("Bring at least 12 charges. 🙂", Q, []),
    ("Bring at least 12 charges. [1]", Q, []),
    ("Bring at least 12 charges.\n- Iron shield\n- Two rings", Q, []),
    ("42", Q, []),
    ("Paris is the capital of France", "What is the capital of France?", []),
    ("Paris is the", "What is the capital of France?", ["truncated"]),
    ("The king fell :( but came back.", Q, []),
    ("Use this:\n```\nrun()\n```", Q, []),
    ("Go on.\n- Bring a shield.\n- Keep the keys.\n- Then go", Q, ["truncated"]),
    ("Go on.\n- Escudo de hierro\n- Escudo de hi", "Qué equipo sirve contra el jefe?", ["truncated"]),
    ("Лучше всего идти туда ночью.", Q, ["wrong_language"]),
    ("そこへ行くには夜がいいです。", Q, ["wrong_language"]),
    ("밤에 가는 것이 좋습니다.", "怎么打赢这个首领？", ["wrong_language"]),
    ("Bring a shield and wait for the bell.", "Cómo derroto al jefe con pociones?", ["wrong_language"]),
    ("Il faut attendre la nuit pour cela.", Q, ["wrong_language"]),
    ("That request is something we aren't permitted to fulfil.", Q, ["refusal"]),
    ("We are not able to assist with this request.", Q, ["refusal"]),
    ("I’m not able to assist with requests of this type. If you need support, ask the desk.", Q, ["refusal"]),
    ("Je ne peux malheureusement pas répondre à cette question.", "Comment battre le chef avec des potions ?", ["refusal"]),
    ("Não posso ajudar com isso.", "Como derroto o chefe com as poções?", ["refusal"]),
    ("申し訳ありませんが、その質問にはお答えできません。", "そこへ行くにはどうすればいいですか？", ["refusal"]),
    ("Извините, я не могу ответить на этот вопрос.", "Как победить босса?", ["refusal"]),
]


@pytest.mark.parametrize("answer,question,wanted", CASES)
def test_rules(answer, question, wanted):
    found = defects_of(answer, question)[0]
    assert found[: len(wanted)] == wanted and bool(found) == bool(wanted)


def test_every_type_is_told(spark):
    df = spark.createDataFrame([(1, "Warum steigt mein Gorofima ab Stufe 12 nicht weiter", "x"), (2, "Bring charges.", None)], "id int, answer string, defect string")
    df = df.selectExpr("*", "case id when 1 then 'Where is it, and how do I get there?' end as question", "'z' as _last", "'z' as entry")
    got = {r.id: (r.defects, r.defect, r.entry) for r in answer_defects(df, "answer", "question").collect()}
    assert got == {1: (["wrong_language", "truncated"], "wrong_language", "z"), 2: ([], None, "z")}


def test_cut_list_entry(spark):
    texts = [f"Go left at gate {i}.\n- Iron shield\n- Two rings" for i in range(4)] + ["Go right.\n- Two rings\n- Iron sh", "Go on.\n- Two rings\n- Iron shield"]
    # 'sh' is no word of any answer, but begins one.
    df = spark.createDataFrame([(i, t, "Where do I go?") for i, t in enumerate(texts)], "id int, a string, q string")
    assert [r.id for r in answer_defects(df, "a", "q").where("defect = 'truncated'").collect()] == [4]


def test_long_and_empty_inputs(spark):
    long = "Bring charges, because it heals. " * 20_000
    df = spark.createDataFrame([(1, long, Q), (2, long.strip()[:-6], Q), (3, None, None)], "id int, a string, q string")
    got = {r.id: r.defect for r in answer_defects(df, "a", "q").collect()}
    assert got == {1: None, 2: "truncated", 3: "empty"}
    assert answer_defects(df.limit(0), "a", "q").count() == 0


def test_cut_entry_that_no_other_answer_has(spark):
    full, free = ('{"finish_reason": "length", "completion_tokens": %d, "max_tokens": 40}' % n for n in (40, 20))
    cut, whole, marked = "Go right.\n- Brass key\n- Amber lant", "Go on.\n- Amber lamp\n- Brass key", "Go up.\n- Brass key\n- Take the lamp."
    rows = [(1, cut, full), (2, cut, free), (3, cut, None), (4, cut, "{"), (5, whole, full), (6, marked, full)]
    df = spark.createDataFrame(rows, "id int, a string, m string").selectExpr("*", "'Where do I go?' as q")
    assert [r.id for r in answer_defects(df, "a", "q", "m").where("defect = 'truncated'").collect()] == [1]


def test_language_of_a_field_query_is_told_by_its_text():
    assert defects_of("Der Drache ist schwach gegen Feuer.", "game=Tide; ask=Schwachstelle; level=3")[0] == []
    assert defects_of("Der Drache ist schwach gegen Feuer.", "game=Tide; ask=where is the weak point; level=3")[0] == ["wrong_language"]


def test_scripts_and_profiles(spark):
    assert [script(t) for t in ("12", "abc", "去雾港 abc", "идти", "夜がいい", "밤에")] == [None, "latin", "zh", "cyrillic", "ja", "ko"]
    words = {"en": "where shall weak points stand beneath thick stones", "de": "schwachstelle hinter dicken steinen suchen gehen"}
    docs = [(k, t, n if k % 2 else f" {n.upper()} ") for n, t in words.items() for k in range(100, 160)] + [(1, None, "en"), (2, "x", None), (3, "hola", "es")]
    profiles = fit_profiles(spark.createDataFrame(docs, "doc_id int, text string, lang string"), "doc_id", "text", "lang")
    assert set(profiles.triples) == {"en", "de"}
    assert language("weak points", profiles) == "en" and language("schwachstelle suchen", profiles) == "de"
    assert language("weak points", Profiles()) is None and language("zzxx qqyy", profiles) is None
    assert fit_profiles(spark.createDataFrame([], "doc_id int, text string, lang string"), "doc_id", "text", "lang").triples == {}
