"""Citations in the raw responses of answer services, in one form for all of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of providers whose responses have the form of another's.
ALIASES = {"target-model": "internal", "volcengine": "doubao", "bytedance": "doubao"}
_LINK = "struct<title:string,url:string>"
_URI = "struct<title:string,uri:string>"
RESPONSE = (
    f"struct<output:array<struct<type:string,content:array<struct<annotations:array<struct<type:string,title:string,url:string>>>>>>,"
    f"choices:array<struct<message:struct<metadata:struct<grounding_chunks:array<struct<web:{_URI},title:string,uri:string>>,citation_sources:array<{_URI}>,"
    f"citations:array<{_LINK}>,annotations:array<{_LINK}>>>>>>"
)


def _linked(title: Column, url: Column) -> Column:
    return F.struct(title.alias("title"), url.alias("url"))


def citations(provider: Column, response: Column) -> Column:
    """A struct of citations (array of title and url) and has_citations, from a response as JSON.

    One parse serves all forms: annotations of messages (openai), grounding chunks and sources (gemini), citations
    (internal) and annotations (doubao) of the first choice's metadata. Other providers, unreadable and NULL
    responses have none."""
    name = F.lower(F.coalesce(provider, F.lit("")))
    name = F.coalesce(*[F.when(name == a, b) for a, b in ALIASES.items()], name)
    told = F.from_json(response, RESPONSE)
    meta = F.get(told["choices"], F.lit(0))["message"]["metadata"]
    none = F.array().cast(f"array<{_LINK}>")
    kept = lambda x: F.filter(F.coalesce(x, none), lambda c: c.isNotNull())
    messages = F.filter(told["output"], lambda m: m["type"] == "message")
    parts = F.flatten(F.transform(messages, lambda m: F.coalesce(m["content"], F.array().cast("array<struct<annotations:array<struct<type:string,title:string,url:string>>>>"))))
    marks = F.flatten(F.transform(parts, lambda p: F.coalesce(p["annotations"], F.array().cast("array<struct<type:string,title:string,url:string>>"))))
    openai = F.transform(F.filter(marks, lambda a: a["type"] == "url_citation"), lambda a: _linked(a["title"], a["url"]))
    chunks = F.filter(meta["grounding_chunks"], lambda c: c["web"].isNotNull() | c["uri"].isNotNull() | c["title"].isNotNull())
    chunks = F.transform(chunks, lambda c: F.when(c["web"].isNotNull(), _linked(c["web"]["title"], c["web"]["uri"])).otherwise(_linked(c["title"], c["uri"])))
    sources = F.transform(F.filter(meta["citation_sources"], lambda c: c.isNotNull()), lambda c: _linked(c["title"], c["uri"]))
    gemini = F.concat(kept(chunks), kept(sources))
    found = F.when(name == "openai", kept(openai)).when(name == "gemini", gemini).when(name == "internal", kept(meta["citations"])).when(name == "doubao", kept(meta["annotations"]))
    found = F.coalesce(found, none)
    return F.struct(found.alias("citations"), (F.size(found) > 0).alias("has_citations"))
