"""Defects of question and answer pairs, by ordered rules on the texts.

The rules run over Arrow batches in Python, as the same rules in expressions exceed what the JVM compiles
for one stage and then run interpreted, several times slower. Nothing is shuffled but the join of answers
to questions and, for answers that end in a list entry, the lexicon of words."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.canonical import FULL, HALF
from plumbline.llm.languages import WORD, Profiles, language
from plumbline.session import Scratch

#: Types in the order in which the first that holds is the answer's type.
TYPES = ("empty", "copied_question", "refusal", "wrong_language", "truncated")

# Words that stand for no answer, and words after which a text goes on.
PLACEHOLDERS = frozenset("null none nan na nil undefined noanswer todo tbd placeholder emptyresponse blank 无 空 暂无 keineantwort sinrespuesta nulo".split())
DANGLING = frozenset(
    (
        "the a an and of to in for with that from at on by or than as is are was if because while until but which who "
        "der die das den dem des und ein eine einen einem einer mit von für auf im zu zum zur nach bei aus oder als wenn weil denn dass "
        "el la los las un una y de del que en con por para o al su como porque desde hasta "
        "le les des et du qui dans avec pour par sur ou au aux 的 和 与 在 把 被 让 因为 但"
    ).split()
)

# Refusals by language: a negated ability or will, the verbs it keeps from, and other ways to decline.
_EN_NOT = (
    r"(?:cannot|can ?not|can['’]?t|could not|couldn['’]?t|won['’]?t|will not|would not|wouldn['’]?t|(?:am|are|is|['’]m|['’]re) (?:not|un)(?: |-)?(?:currently )?(?:able|allowed|permitted|authori[sz]ed|willing|in a position)(?: to)?|"
    r"aren['’]?t (?:able|allowed|permitted|willing) to|isn['’]?t (?:able|allowed|permitted) to|(?:must|have to|need to|has to) (?:decline|refuse|pass)(?: to)?|decline to|refuse to|(?:am|['’]m|do(?:n['’]?t| not) feel) (?:not )?comfortable)"
)
_EN_DO = r"(?:help|assist|answer|respond|reply|provide|continue|comply|give|discuss|support|share|offer|fulfil|fulfill|process|handle|talk|comment|advise|complete|engage|answering|discussing|helping|providing|giving|sharing|do (?:that|this)|with (?:that|this)|on (?:that|this))"
_ASKED = r"(?:(?:this|that|such|your|the)(?: \w+)? (?:request|question|topic|content|information|query|answer|subject|matter)s?|(?:this|that|it)|such \w+|(?:giving|offering|providing|sharing) \w+(?: \w+)?)"
REFUSALS = (
    rf"\b(?:i|we|this (?:assistant|model|system)|the (?:assistant|model|system))(?=[ '’])[^.!?,;:]*?(?:\b|(?=['’])){_EN_NOT} (?:be able to )?(?:really |further |simply )?(?:{_EN_DO}|$|[.,!;])|\bi['’]?m? (?:have|must|need)(?: to)? (?:decline|refuse|pass)\b",
    rf"\bas an? (?:ai|language model|assistant)\b[^.!?]*\b{_EN_NOT}|\bunable to (?:{_EN_DO})\b|\bi (?:do not|don['’]?t) have enough information\b|\bi(?:['’]d| would)? (?:would )?(?:rather|prefer) not\b",
    rf"\b{_ASKED} (?:is|are|goes|go|falls?|lies?) (?:against|outside|beyond) (?:of )?(?:my|our|what (?:i|we))\b|\b(?:goes|is|falls) (?:against|outside) (?:my|our|what (?:i|we))\b",
    rf"\b{_ASKED} (?:is|are|was)(?: not|n['’]?t) (?:permitted|allowed|supported|possible|something|available)\b|\b(?:is|are)(?: not|n['’]?t) something (?:i|we)\b|\bsomething (?:i|we)(?: am|['’]m| are|['’]re)?(?:n['’]?t| not| cannot| can['’]?t)",
    rf"\b(?:no answer|{_ASKED}) (?:cannot|can['’]?t|can|will not) be (?:provided|given|answered|discussed|fulfilled|processed|completed)\b(?<!that can be provided)",
    # German
    r"\b(?:dabei|damit|hierbei|dazu|darauf|hierzu) kann ich (?:dir |ihnen |euch )?(?:leider )?nicht\b|\b(?:ich kann|kann ich|können wir|wir können) (?:dir |ihnen |leider |hier |darauf |dazu )*(?:diese|auf diese|zu dieser|diesen|nicht|keine)?[^.!?]*\b(?:nicht|keine)\b[^.!?]*\b(?:beantworten|bearbeiten|antworten|erfüllen|helfen|weiterhelfen|dienen|geben|nachkommen|anbieten)\b|\bkann ich [^.!?]*\bnicht (?:beantworten|bearbeiten|antworten|erfüllen|helfen|weiterhelfen)\b",
    r"\b(?:darf|dürfen) (?:ich|wir) [^.!?]*\b(?:keine|nicht)\b|\bmir nicht (?:erlaubt|gestattet|möglich)\b|\b(?:möchte|will) ich (?:lieber )?nicht\b[^.!?]*\b(?:sprechen|reden|antworten|äußern)\b|\bmuss (?:ich )?(?:hier |leider |das |diese \w+ )*ablehnen\b|\bliegt außerhalb (?:meine|unsere)",
    # Spanish
    r"\bno (?:puedo|podemos|me es posible|nos es posible) (?:\w+ )?(?:ayudar\w*|responder\w*|contestar\w*|dar\w*|continuar|ofrecer\w*|proporcionar\w*|atender\w*|cumplir\w*|hablar)\b|\bno se me permite\b|\bno (?:estoy|tengo) (?:autorizad|permitid)\w+",
    r"\bprefiero no (?:hablar|responder|opinar|tratar|contestar)\b|\b(?:debo|tengo que) (?:rechazar|declinar)\b|\bqueda fuera de (?:mi|mis|nuestr)\w*",
    # French, Italian, Portuguese
    r"\bje ne (?:peux|puis|suis) (?:malheureusement )?pas\b[^.!?]*\b(?:aider|répondre|fournir|donner|continuer|discuter|autorisée?|en mesure|satisfaire)|\b(?:je dois|je préfère) (?:décliner|refuser|ne pas)\b|\bil ne m['’]est pas (?:possible|permis)\b",
    r"\bnon posso (?:\w+ )?(?:aiutar\w*|risponder\w*|fornir\w*|dar\w*|continuar\w*|discuter\w*)|\bnon mi è (?:possibile|permesso)\b|\bnão (?:posso|consigo|me é possível) (?:\w+ )?(?:ajudar|responder|fornecer|dar|continuar|discutir|atender)",
    # Chinese, Japanese, Korean, Russian
    r"(?:我|我们|本助手|系统)(?:现在|暂时|实在)?(?:无法|不能|没法|不便|不可以|没办法)(?:继续|回答|提供|讨论|协助|帮助|给出|处理|满足|答复|帮)|(?:话题|问题|内容)我不便|不便(?:讨论|回答)|我不能继续|我没有足够的信息|超出了?我的|(?:暂)?不支持回答|允许我拒绝|拒绝(?:作答|回答)|不符合(?:使用)?(?:规范|规定|准则)",
    r"(?:お答え|回答|お手伝い|対応|提供|お応え)(?:することは|は)?(?:でき(?:ません|ない|かねます)|いたしかねます)|(?:답변|도움|도와|제공)[^.!?]{0,12}(?:없습니다|어렵습니다|불가)|я не могу (?:помочь|ответить|предоставить|обсуждать|дать|продолжить)|не могу (?:помочь|ответить) (?:на|с|вам)",
)
COURTESIES = (
    r"^(?:sorry|unfortunately|thanks|thank you|my apologies|i appreciate|please|feel free|is there anything|if you need|hmm|regarding|at this time|i hope|i['’]m sorry|i am sorry|apologies)",
    r"^(?:entschuldigung|leider|danke|es tut mir leid|bitte|stell|zu )",
    r"^(?:lo siento|disculpa|por desgracia|gracias|por ahora|consulta|puedes preguntar|sobre )",
    r"^(?:désolé|je suis désolé|malheureusement|merci|veuillez|mi dispiace|purtroppo|grazie|desculpe|infelizmente|obrigad)",
    r"^(?:抱歉|对不起|很遗憾|不好意思|很抱歉|感谢|目前|关于|如有|您可以|请|申し訳|すみません|죄송|извините|к сожалению)",
)

ENDS = tuple(".!?。！？…‥")
CLOSERS = "\"'”’»)]）】》」』"
PAIRS = ("()", "（）", "“”", "【】", "「」", "『』", "《》", "[]", "{}")
#: Words (or Chinese characters, by half) of a short answer or entry that needs no closing mark.
SHORT = 7
WIDTH = str.maketrans(FULL, HALF)
ANY_WIDE = re.compile("[！-～　 ]")
ANY_MARKUP = re.compile(r"[<&\[*`#~]|__")
MARKUP = [
    (re.compile(p), put)
    for p, put in (
        (r"<[^<>]*>", " "),
        (r"&(?:[a-zA-Z]{2,10}|#\d{1,6});", " "),
        (r"```\w*", " "),
        (r"\[([^\[\]]*)\]\([^()]*\)", r"\1"),
        (r"[*`#~]+|__+", " "),
    )
]
NOT_WORD = re.compile(r"[\W_]+")
ASKED_FOR = re.compile(r"(?:^|[{|;；\n\r\"])\s*\"?ask\"?\s*[=:：＝]\s*\"?([^\"|;；\n\r}]*)", re.I)
BEFORE_COPY = re.compile(r"^(?:question|query|frage|pregunta|consulta|问题|问|提问|q|user|you asked)")
DECLINES = re.compile("|".join(f"(?:{p})" for p in REFUSALS))
IDLE = re.compile("|".join(f"(?:{p})" for p in COURTESIES))
SENTENCE = re.compile(r"(?<=[.!?。])\s+|(?<=[。!?])|\n")
LIST_LINE = re.compile(r"\s*(?:[-*•·]|\d{1,2}[.)])\s+")
BARE_MARK = re.compile(r"\s*(?:[-*•·]|\d{1,2}[.)]?)\s*")
TAIL = re.compile(r"(?:\[\d+\]|\(v\d+\)|&nbsp;|</?\w+\s*/?>)$")
CLAUSE = re.compile(r"[.!?。！？…,，;；:：、]")
EMOTICON = re.compile(r"[:;=]-?[(\[{]")
CHINESE = re.compile("[㐀-鿿豈-﫿]")


def without_markup(text: str) -> str:
    """The text in half width without tags, entities, fences, emphasis, heading marks and link targets."""
    if ANY_MARKUP.search(text):
        for pattern, put in MARKUP:
            text = pattern.sub(put, text)
    return text.translate(WIDTH) if not text.isascii() and ANY_WIDE.search(text) else text


def bare(text: str) -> str:
    """Letters and digits of a text in lower case and half width, without markup."""
    return NOT_WORD.sub("", without_markup(text).lower())


class Pair:
    """An answer and a question with what several rules need of them."""

    def __init__(self, answer: str | None, question: str | None):
        self.answer, self.question = answer or "", question
        self.plain = without_markup(self.answer).lower()
        self.told = NOT_WORD.sub("", self.plain)
        self.asked_plain = without_markup(question).lower() if question else ""
        self.asked = NOT_WORD.sub("", self.asked_plain)

    def is_empty(self) -> bool:
        """Nothing readable: NULL, blanks, markup or a placeholder."""
        return not self.told or self.told in PLACEHOLDERS

    def is_copy(self) -> bool:
        """The answer has the question's letters, once or repeated, perhaps after a word like 'Question'."""
        asked, told = self.asked, self.told
        if not asked or asked not in told:
            return False
        return any(x and len(x) % len(asked) == 0 and x == asked * (len(x) // len(asked)) for x in (told, BEFORE_COPY.sub("", told)))

    def is_refusal(self) -> bool:
        """A sentence declines, and at most one sentence is neither that nor a courtesy nor the question's own."""
        declined, others = False, 0
        for sentence in SENTENCE.split(self.plain):
            sentence = sentence.strip()
            if not WORD.search(sentence):
                continue
            if DECLINES.search(sentence):
                declined = True
            elif not IDLE.search(sentence) and NOT_WORD.sub("", sentence) not in self.asked:
                others += 1
                if others > 1:
                    return False
        return declined

    def is_foreign(self, profiles: Profiles | None) -> bool:
        """The languages of the answer and of the question are told and differ; of a question written as
        named fields only the field that asks counts."""
        if not self.question:
            return False
        own = language(self.plain, profiles)
        if own is None:
            return False
        field = ASKED_FOR.search(self.question)
        asked = language(without_markup(field[1]).lower() if field else self.asked_plain, profiles)
        return asked is not None and own != asked


def _without_tail(text: str) -> str:
    """The text without blanks, emphasis, symbols, notes and tags at its end."""
    size = -1
    while len(text) != size:
        size = len(text)
        text = text.rstrip().rstrip("*_`~️‍")
        while text and text[-1] > "\x7f" and unicodedata.category(text[-1]) in ("So", "Sk"):
            text = text[:-1]
        text = TAIL.sub("", text)
    return text


def _is_closed(text: str) -> bool:
    return text.rstrip(CLOSERS).endswith(ENDS)


def _is_open(answer: str) -> bool:
    """A code fence, bracket or quotation was opened and not closed."""
    if answer.count("```") % 2:
        return True
    if any(answer.count(a) > answer.count(b) for a, b in PAIRS):
        answer = EMOTICON.sub("", answer)
        return any(answer.count(a) > answer.count(b) for a, b in PAIRS)
    return False


def _dangles(line: str) -> bool:
    """Ends with a mark or a word after which a text goes on."""
    words = WORD.findall(line.lower())
    return line.endswith(tuple(",，;；:：、-–—(（")) or bool(words) and (words[-1] in DANGLING and not line[-1:].isdigit())


def _size(line: str) -> float:
    chars = len(CHINESE.findall(line))
    return chars / 2 + len(WORD.findall(CHINESE.sub(" ", line)))


def truncation(answer: str) -> tuple[bool, str | None]:
    """Whether an answer is cut, and, where its own text doesn't tell, its last word in lower case.

    A closing mark ends an answer, unless a delimiter is left open. Without one it is complete if it ends
    like the other entries of its list, with a closed fence or a table's row, or is short and of one clause."""
    text = _without_tail(answer)
    if _is_open(answer):
        return True, None
    last = text.rpartition("\n")[2]
    if "\n" in text and BARE_MARK.fullmatch(last):
        return True, None
    if _is_closed(text):
        return False, None
    if answer.rstrip().endswith("```") or last.strip().startswith("|") and last.strip().endswith("|"):
        return False, None
    words = WORD.findall(last.lower())
    if "\n" in text and LIST_LINE.match(last):
        entries = [x for x in text.split("\n")[:-1] if LIST_LINE.match(x)]
        bodies = [LIST_LINE.sub("", x, count=1).strip().lower() for x in entries]
        body = LIST_LINE.sub("", last, count=1).strip().lower()
        longest = max([SHORT / 2, *map(_size, bodies)])
        cut = _dangles(body) or bool(CLAUSE.search(body)) and not any(CLAUSE.search(x) for x in bodies) or bool(entries) and all(map(_is_closed, entries)) or _size(body) > 2 * longest
        cut = cut or body not in bodies and any(x.startswith(body) for x in bodies)
        return cut, words[-1] if words and not cut and last[-1:].isalpha() else None
    if "\n" in text or CLAUSE.search(re.sub(r"(?<=\d)[.,:](?=\d)", "", text)) or _size(text) > SHORT or _dangles(text):
        return True, None
    return False, words[-1] if words and text[-1:].isalpha() else None


def defects_of(answer: str | None, question: str | None, profiles: Profiles | None = None) -> tuple[list[str], str | None]:
    """Every type that holds for one pair, in the order of TYPES, and the last word that a lexicon is to judge."""
    pair = Pair(answer, question)
    if pair.is_empty():
        return ["empty"], None
    found = []
    if pair.is_copy():
        found.append("copied_question")
    if pair.is_refusal():
        found.append("refusal")
    if pair.is_foreign(profiles):
        found.append("wrong_language")
    cut, word = truncation(pair.answer)
    if cut:
        found.append("truncated")
    elif word:
        names = [n for n in WORD.findall(pair.asked_plain) if len(n) > 2]
        if any(n in word for n in names):
            word = None  # whole, as the question has it
        elif len(word) > 1 and any(n.startswith(word) for n in names if len(n) > 4):
            found.append("truncated")
            word = None
    return found, word


def at_limit(metadata: str | None) -> bool:
    """The metadata say that generation stopped at its limit of tokens."""
    if not metadata or "length" not in metadata:
        return False
    try:
        told = json.loads(metadata)
    except ValueError:
        return False
    if not isinstance(told, dict) or told.get("finish_reason") != "length":
        return False
    used, most = told.get("completion_tokens"), told.get("max_tokens")
    return isinstance(used, (int, float)) and isinstance(most, (int, float)) and used >= most


def answer_defects(pairs: DataFrame, answer: str, question: str, metadata: str | None = None, profiles: Profiles | None = None) -> DataFrame:
    """``pairs`` with two more columns: defects (array of every type that holds, in the order of TYPES) and
    defect (its first, NULL for a sound answer).

    A NULL question only keeps the rules that need one from holding; an empty answer has no other defect.
    An answer without a closing mark that else looks complete is held against the lexicon of all words
    that stand inside the answers: it is truncated if its last word is none of them but begins one, or if
    it is unknown and ``metadata`` (a column of JSON) tells that the answer reached the limit of tokens; that alone
    isn't proof, as many answers that reach it are complete. ``profiles`` help to tell languages. Texts
    are read whole. Columns named defects, defect, _last, _full, _words or _state are replaced."""
    rows = pairs.drop("defects", "defect", "_words", "_last", "_full", "_state")
    texts = T.ArrayType(T.StringType())
    added = [T.StructField("defects", texts), T.StructField("_last", T.StringType()), T.StructField("_full", T.BooleanType()), T.StructField("_words", texts)]
    schema = T.StructType([*rows.schema.fields, *added])
    shipped = pairs.sparkSession.sparkContext.broadcast(profiles)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            told, asked = batch.column(answer).to_pylist(), batch.column(question).to_pylist()
            said = batch.column(metadata).to_pylist() if metadata else [None] * len(told)
            found, last, full, words = [], [], [], []
            for a, q, m in zip(told, asked, said):
                types, word = defects_of(a, q, own)
                found.append(types)
                last.append(word)
                full.append(word is not None and at_limit(m))
                # Words of lists are what the last entries of lists can be held against.
                inner = a.rstrip().rpartition("\n")[0] if a and "\n" in a else ""
                words.append(list(set(WORD.findall(inner.lower()))) if inner and LIST_LINE.search(inner) else None)
            columns = [pa.array(found, pa.list_(pa.string())), pa.array(last, pa.string()), pa.array(full, pa.bool_()), pa.array(words, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *(f.name for f in added)])

    judged = Scratch(pairs.sparkSession, "defects").save(rows.mapInArrow(judge, schema))
    known = judged.select(F.explode("_words").alias("word")).distinct()
    ends = judged.where("_last is not null").select(F.col("_last").alias("word")).distinct()
    whole = ends.join(known.withColumn("_whole", F.lit(True)), "word", "left")
    begun = known.select(F.explode(F.expr("transform(sequence(1, greatest(length(word) - 1, 1)), i -> left(word, i))")).alias("word")).distinct().withColumn("_begun", F.lit(True))
    state = F.when(F.col("_whole"), "whole").when(F.col("_begun"), "begun").otherwise("unknown")
    ends = whole.join(begun, "word", "left").select(F.col("word").alias("_last"), state.alias("_state"))
    cut = F.coalesce((F.col("_state") == "begun") | (F.col("_state") == "unknown") & F.col("_full"), F.lit(False)) & ~F.array_contains("defects", "truncated")
    defects = F.when(cut, F.array_append("defects", F.lit("truncated"))).otherwise(F.col("defects"))
    done = judged.drop("_words").join(ends, "_last", "left").withColumn("defects", defects).select(*rows.columns, "defects")
    return done.withColumn("defect", F.get("defects", F.lit(0)))
