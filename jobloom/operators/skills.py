"""Skills tagged in postings by pattern and similarity, exploded for export."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:
    import ahocorasick
except ImportError:
    ahocorasick = None

from jobloom import schemas
from jobloom.functions.similarity import best_window_ratio, codes_of
from jobloom.functions.text import preprocess_description

TOP, LEAST = 20, 70.0
#: Largest dictionary that goes to every worker.
MOST_SKILLS = 200_000
#: Texts whose skills a task holds at a time; a text is a Python string only while it is read.
TEXTS = 256
_TAGGED = pa.schema([("pst_id", pa.string()), ("skills", pa.list_(pa.struct([("skill_code", pa.string()), ("similarity", pa.float64())])))])


def unwrap_pattern(key: object) -> re.Pattern | None:
    """Compiled pattern of an ext_key: r'...' and a leading (?i) may be around it.
    None of what is no string or no pattern."""
    if not isinstance(key, str):
        return None
    text = key.strip()
    if len(text) > 2 and text[0] == "r" and text[1] in "'\"" and text[-1] == text[1]:
        text = text[2:-1]
    flags = re.IGNORECASE if text.startswith("(?i)") else 0
    try:
        return re.compile(text.removeprefix("(?i)"), flags)
    except re.error:
        return None


#: Characters beside ASCII that a case-insensitive pattern takes for ASCII letters.
_ALIKE = "ſKıİ"


class Literal:
    """A pattern of plain ASCII characters: a substring test does for its search."""

    def __init__(self, pattern: re.Pattern) -> None:
        self.pattern, self.fold = pattern, bool(pattern.flags & re.IGNORECASE)
        self.word = pattern.pattern.lower() if self.fold else pattern.pattern

    def found(self, text: str, lower: str, plain: bool) -> bool:
        if not self.fold:
            return self.word in text
        return self.word in lower if plain else bool(self.pattern.search(text))


class Pattern(Literal):
    def found(self, text: str, lower: str, plain: bool) -> bool:
        return bool(self.pattern.search(text))


def searcher(pattern: re.Pattern) -> Literal:
    simple = pattern.pattern.isascii() and re.fullmatch(r"[\w ]+", pattern.pattern)
    return Literal(pattern) if simple else Pattern(pattern)


class Dictionary:
    """Patterns by code. Literals are found in one pass over a text by an automaton,
    where the library for it is there; the others are searched one by one."""

    def __init__(self, skills: list[tuple[str, str, Literal]]) -> None:
        self.skills, self.others, words = skills, [], {False: {}, True: {}}
        for entry in skills:
            pattern = entry[2]
            if type(pattern) is Literal and ahocorasick:
                words[pattern.fold].setdefault(pattern.word, []).append(entry)
            else:
                self.others.append(entry)
        self.folded, self.exact = (self._automaton(words[fold]) for fold in (True, False))

    @staticmethod
    def _automaton(words: dict):
        if not words:
            return None
        out = ahocorasick.Automaton()
        for word, entries in words.items():
            out.add_word(word, entries)
        out.make_automaton()
        return out

    def found(self, text: str, lower: str) -> list[tuple[str, str, Literal]]:
        plain = not any(c in text for c in _ALIKE)
        if not plain:  # there folding changes more than ASCII letters
            return [e for e in self.skills if e[2].found(text, lower, plain)]
        hits = {}
        for automaton, own in ((self.folded, lower), (self.exact, text)):
            if automaton is not None:
                for _, entries in automaton.iter(own):
                    hits.setdefault(id(entries), entries)
        return [e for entries in hits.values() for e in entries] + [e for e in self.others if e[2].found(text, lower, plain)]


def compiled(skills: DataFrame) -> list[tuple[str, str, Literal]]:
    """(code, name in lower case, pattern) by code. The dictionary is a dimension of
    bounded size, held by each worker."""
    rows = skills.filter("ext_key is not null and skill_name is not null").select("skill_code", "skill_name", "ext_key").limit(MOST_SKILLS + 1).collect()
    if len(rows) > MOST_SKILLS:
        raise ValueError(f"a dictionary of more than {MOST_SKILLS} skills is to be split and tagged in parts")
    return [(r[0], r[1].lower(), searcher(p)) for r in sorted(rows) if (p := unwrap_pattern(r[2]))]


def tag(text: str, skills: Dictionary, top: int = TOP, least: float = LEAST) -> list[tuple[str, float]]:
    """The `top` most similar skills whose pattern is in the text, ties by code."""
    lower, found = text.lower(), []
    codes = codes_of(lower)
    for code, name, _ in skills.found(text, lower):
        if (ratio := best_window_ratio(name, lower, least, codes)) >= least:
            found.append((-ratio, code))
    return [(code, -ratio) for ratio, code in sorted(found)[:top]]


def match_skills(postings: DataFrame, skills: DataFrame, top: int = TOP, least: float = LEAST) -> DataFrame:
    """(pst_id, skills): array of (skill_code, similarity), best first, of each
    posting with any hit. No shuffle: a task compiles the dictionary once."""
    known = compiled(skills)

    def matched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Dictionary(known)
        for part in (p.slice(at, TEXTS) for p in parts for at in range(0, len(p), TEXTS)):
            rows = [{"pst_id": i.as_py(), "skills": [{"skill_code": c, "similarity": r} for c, r in tag(t.as_py(), own, top, least)]} for i, t in zip(part["pst_id"], part["text"], strict=True)]
            yield pa.RecordBatch.from_pylist([r for r in rows if r["skills"]], _TAGGED)

    texts = postings.select("pst_id", preprocess_description("pst_detail").alias("text")).filter("text <> ''")
    return texts.mapInArrow(matched, "pst_id string, skills array<struct<skill_code:string,similarity:double>>")


def joined_columns(tagged: DataFrame, skills: DataFrame) -> DataFrame:
    """(pst_id, skill_code, skill_name) as comma lists, best first."""
    each = tagged.select("pst_id", F.posexplode("skills").alias("at", "s")).select("pst_id", "at", "s.skill_code")
    named = each.join(skills.select("skill_code", "skill_name"), "skill_code", "left")
    lists = named.groupBy("pst_id").agg(F.array_sort(F.collect_list(F.struct("at", "skill_code", "skill_name"))).alias("l"))
    return lists.select("pst_id", F.array_join("l.skill_code", ",").alias("skill_code"), F.array_join("l.skill_name", ",").alias("skill_name"))


def expand(postings: DataFrame, skills: DataFrame) -> DataFrame:
    """One row a posting and skill of its comma list, with the dictionary's columns,
    all as strings; codes that the dictionary hasn't keep nulls."""
    names = [c for c in schemas.EXPORT if c not in (*schemas.SKILL, "skill_name")]
    have = {c: F.col(c) if c in postings.columns else F.lit(None) for c in names}
    rows = postings.filter("skill_code is not null and skill_code <> ''").withColumn("skill_code", F.explode(F.split("skill_code", ",")))
    rows = rows.select(*[v.cast("string").alias(c) for c, v in have.items()], F.trim("skill_code").alias("skill_code"))
    return rows.join(skills.select([c for c in schemas.SKILL if c != "ext_key"]), "skill_code", "left").select(*[F.col(c).cast("string") for c in schemas.EXPORT])


def shard_of(key: str, shards: int) -> Column:
    """The number of a row's shard: the first 32 bits of the key's MD5, so that other
    engines deal alike. Null keys are in shard 0."""
    return F.coalesce(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % shards, F.lit(0)).cast("int")


def shard(rows: DataFrame, shards: int, number: int, key: str = "pst_id") -> DataFrame:
    """The rows of one of several shards by hash."""
    return rows.filter(shard_of(key, shards) == number)
