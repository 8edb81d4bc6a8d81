"""Problem 1: variant spellings of names typed by people.

Distinct values are parsed (titles, degrees, byline words, places and codes are set aside; roles, blanks and lists of several people
are left out) into tokens. Candidates come from suffix blocking: every token is indexed by its suffix of a minimum length, shorter ones
whole; suffixes that very many values share are replaced by longer suffixes and by the suffix refined with the other tokens of the
value, what is common still by keys with more of both, and only after that the common key itself is given up; values that share even
the narrowest keys are compared by pairs of blocks. Candidate pairs are compared by the longest-common-subsequence ratio of their
aligned tokens. Every value points to its best fuller or more frequent neighbour, and the trees of these pointers are the entities;
values that fit several entities equally (an initial and a surname) belong to none of them.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lontar.functions.lcs import lcs_length, lcs_ratio_of
from lontar.session import cut

#: Words that name a role or a desk and not who holds it.
ROLES = {
    "redaksi", "redaktur", "admin", "administrator", "editor", "kontributor", "contributor", "newsroom", "tim", "team", "reporter", "penulis", "wartawan", "jurnalis", "koresponden", "staf", "staff",
    "desk", "web", "operator", "author", "writer", "anonim", "anonymous", "pewarta", "penyunting", "humas", "magang", "unknown", "none", "null", "na",
}
#: Words that mark a news agency.
AGENCY = {"kantor", "kntr", "berita", "kb", "agency", "agensi"}
BYLINE = re.compile(r"^\s*(?:oleh|penulis|by|reporter|laporan|teks|pewarta|written by|ditulis oleh)\s*[:\-]?\s+(?=\S)", re.I)
BYLINE_COLON = re.compile(r"^\s*(?:oleh|penulis|by|reporter|laporan|teks|pewarta|editor|penyunting)\s*:\s*(?=\S)", re.I)
TITLES = {"dr", "drs", "dra", "drg", "hj", "h", "haji", "hajah", "prof", "ir", "kh", "ustaz", "ust", "ny", "tn", "bapak", "ibu", "mr", "mrs", "ms"}
SEVERAL = re.compile(r"\s*(?:;|&|\||\+|/|\s(?:dan|and|bersama|dengan|with)\s)\s*", re.I)
DEGREE = re.compile(r"^\s*(?:[A-Z][A-Za-z]{0,3}\.\s?(?:[A-Za-z]{1,5}\.?\s?){0,3}|[A-Z]{2,4}|[A-Z][a-z]{0,2}[A-Z]{1,2}|Ph\.?D\.?)\s*$")
_LOOK = str.maketrans("013457", "oieast")


def fold(s: str) -> str:
    """Lower case without accents and invisible characters; digits inside words read as the letters they look like."""
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").lower()
    return re.sub(r"\w*[a-z]\w*", lambda m: m[0].translate(_LOOK), s)


def _tokens(s: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", fold(s)) if w]


def near(a: str, b: str) -> bool:
    """Whether two words differ by at most one edit or swap of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (i + 1 < len(a) and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :])
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return long[i + 1 :] == short[i:]


def _is(word: str, known: set[str]) -> bool:
    return word in known or (len(word) >= 5 and any(len(k) >= 5 and near(word, k) for k in known))


def parse(value: str | None) -> tuple[str, list[str]] | None:
    """('org' or 'person', tokens) of one value; None for blanks, bare roles and several names.

    An organisation's tokens are its name without the words that say it is a newsroom or an agency.
    """
    if value is None or not any(c.isalpha() for c in value):
        return None
    s = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", value)).strip()
    s = BYLINE.sub("", BYLINE_COLON.sub("", s))
    s = re.sub(r"\s+[-–—]\s*(?:kontributor|koresponden|reporter|wartawan|contributor|editor)\b.*$", "", s, flags=re.I)
    inside = re.findall(r"\(([^)]*)\)", s)
    agency = any(_is(w, AGENCY) for i in inside for w in _tokens(i))
    s = re.sub(r"\([^)]*\)", " ", s)
    s = re.sub(r"[\"“”'‘’][^\"“”'‘’]*[\"“”'‘’]", " ", s)
    pieces = [p for p in SEVERAL.split(s) if p.strip()]
    bare = [p for p in pieces if not all(_is(w, ROLES) for w in _tokens(p))]
    role = len(bare) < len(pieces)
    if len(bare) != 1:
        return None  # only roles, or several names
    head, *tail = bare[0].split(",")
    tail = [t for t in tail if t.strip() and not DEGREE.match(t)]
    if len(tail) > 1:
        return None
    words = _tokens(tail[0]) + _tokens(head) if tail else _tokens(head)
    while len(words) > 1 and words[0] in TITLES and not (len(words[0]) == 1 and len(words) < 3):
        words = words[1:]
    if any(_is(w, AGENCY) for w in words) and len(words) > 1:
        agency, words = True, [w for w in words if not _is(w, AGENCY)]
    if any(_is(w, ROLES) for w in words):
        role, words = True, [w for w in words if not _is(w, ROLES)]
    if not words or all(len(w) == 1 for w in words):
        return None
    if role or agency:
        return "org", ["".join(words)]
    return "person", words


def _token_score(a: str, b: str) -> float:
    """How well two tokens name the same: 1 equal, else by LCS ratio, initials and short forms; 0 no."""
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1:
        return 0.6 if b[0] == a else 0.0
    r = lcs_ratio_of(a, b)
    if len(a) >= 5 and len(b) - len(a) <= 2 and r >= (0.85 if len(b) >= 8 else 0.8):
        return r
    if len(a) <= 6 and len(b) >= 6 and (a in b or (len(a) >= 4 and a[:3] == b[:3])):
        return 0.7  # a nickname
    if 3 <= len(a) <= 6 < len(b) and lcs_length(a, b) >= max(2, len(a) - 1):
        return 0.65
    return 0.0


def same(a: list[str], b: list[str], kind_a: str, kind_b: str, threshold: float = 0.8) -> float:
    """Score of two parsed values naming the same, 0 if they don't; at most 1. Under 0.75 it is weak: other entities may fit as well."""
    ja, jb = "".join(a), "".join(b)
    if "org" in (kind_a, kind_b):
        r = lcs_ratio_of(ja, jb)
        return r if ja == jb or (min(len(ja), len(jb)) >= 6 and r >= 0.88) else 0.0
    if sorted(a) == sorted(b):
        return 1.0
    if (len(a) == 1 or len(b) == 1 or len(a) != len(b)) and abs(len(ja) - len(jb)) <= 3 and min(len(ja), len(jb)) >= 10:  # tokens written together
        fewer, more = (a, b) if len(a) <= len(b) else (b, a)
        orders = list(itertools.permutations(more)) if len(more) <= 4 else [more]
        r = max(lcs_ratio_of("".join(x), "".join(o)) for x in (fewer, fewer[::-1]) for o in orders)
        if r >= 0.93:
            return 0.99 * r
    if len(a) > len(b):
        a, b = b, a
    if len(a) < 2:
        return 0.0
    free, got = list(range(len(b))), []
    for x in sorted(a, key=len, reverse=True):
        best = max(free, key=lambda j: _token_score(x, b[j]), default=None)
        s = _token_score(x, b[best]) if best is not None else 0.0
        if not s:
            return 0.0
        free.remove(best)
        got.append((s, len(x), x, b[best]))
    whole = [s for s, n, _, _ in got if n > 1 and s > 0.75]
    if not whole:
        return 0.0
    aligned_a, aligned_b = "".join(x for _, _, x, _ in got), "".join(y for _, _, _, y in got)
    if len(whole) == len(got) and lcs_ratio_of(aligned_a, aligned_b) < threshold:
        return 0.0
    mean = sum(s for s, *_ in got) / len(got)
    if len(whole) == 1 and len(got) == 2:
        return min(0.74, mean)  # an initial or nickname and one name
    return mean - 0.02 * len(free)


def _ends(tokens: list[str], least: int) -> Iterator[tuple[int, str, str]]:
    """(token's number, its suffix, the token): by the suffix of ``least`` letters, also without the last letter; shorter tokens count
    whole, and where the last token is short so does the suffix of the tokens written together (their number is -1)."""
    for i, t in enumerate(tokens):
        if len(t) >= least:
            for v in (t, t[:-1]):
                if len(v) >= least:
                    yield i, v[-least:], v
        elif len(t) > 1:
            yield i, "=" + t, t
    whole = "".join(tokens)
    if len(tokens) > 1 and len(tokens[-1]) < least <= len(whole):
        yield -1, whole[-least:], whole


def _suffixes(tokens: list[str], least: int) -> set[str]:
    return {s for _, s, _ in _ends(tokens, least)}


def _others(tokens: list[str], i: int, t: str, least: int) -> list[str]:
    """What a token is refined with: the other tokens, or itself where nothing else is there or tokens may be written together."""
    own = [t] if len(t) > least + 6 or len(tokens) == 1 or i < 0 else []
    return own + [o for j, o in enumerate(tokens) if j != i and i >= 0]


def _refined(tokens: list[str], least: int, suffix: str) -> set[str]:
    """Keys that stand for a common suffix: longer suffixes and the suffix with the beginnings, initials and ends of other tokens."""
    out = set()
    for i, s, t in _ends(tokens, least):
        if s == suffix:
            if s[0] != "=":
                out.add("+" + t[-least - 3 :])
            for o in _others(tokens, i, t, least):
                out |= {f"{s}<{o[:3]}", f"{s}>{o[-3:]}", f"{s}.{o[0]}"}
    return out


def _narrowed(tokens: list[str], least: int, key: str) -> set[str]:
    """Keys that stand for a refined key that is common still: with the rest of what was refined with and the token's own beginning,
    one of which a single slip leaves as it is, and with every third token."""
    out = set()
    for i, s, t in _ends(tokens, least):
        if key == "+" + t[-least - 3 :]:
            out |= {f"{key}^{t[:3]}"} | {f"{key}<{o[:3]}" for o in _others(tokens, i, t, least)} | {f"{key}>{o[-3:]}" for o in _others(tokens, i, t, least)}
        for o in _others(tokens, i, t, least):
            if key in (f"{s}<{o[:3]}", f"{s}>{o[-3:]}", f"{s}.{o[0]}"):
                out |= {f"{key}^{t[:3]}", f"{key}~{o[3:6]}", f"{key}~{o[:3]}{o[-3:]}"}
                out |= {f"{key}&{x[:3]}" for k, x in enumerate(tokens) if k != i and x != o}
    return out or {key}


def _spread(node: str, key: str, count: int, most: int) -> list[str]:
    """A key that over ``most`` values share, as one key for each pair of blocks that the value's block is in."""
    k = -(-count // max(1, most))
    mine = zlib.crc32(node.encode("utf-8", "surrogatepass")) % k
    return [f"{key}#{min(mine, o)},{max(mine, o)}" for o in range(k)]


def link_names(values: DataFrame, name_col: str = "author_name", least: int = 5, common: int = 200, crowded: int = 1000) -> DataFrame:
    """(name, entity): values, byte for byte as stored, with the value that stands for their entity.

    A suffix that over ``common`` values share is refined, a refined key that over ``crowded`` share is narrowed, and what is crowded
    still is compared by pairs of blocks.

    Blank and null values, bare roles and several names are in no entity. Repeated rows count for frequency only. A value that very
    many rows hold is counted before anything is shuffled. An empty table gives no rows; other columns are ignored.
    """
    distinct = values.select(F.col(name_col).cast("string").alias("name")).where("name is not null").groupBy("name").agg(F.count("*").alias("n"))

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = [parse(x) for x in b["name"]]
            yield pd.DataFrame({"name": b["name"], "n": b["n"], "kind": [x[0] if x else None for x in p], "tokens": [x[1] if x else [] for x in p]})

    people = cut(distinct.mapInPandas(parsed, "name string, n long, kind string, tokens array<string>").where("kind is not null"))
    # values that parse alike are one node
    node = F.concat_ws(" ", F.array_sort("tokens"))
    nodes = cut(people.groupBy(node.alias("node")).agg(F.max("kind").alias("kind_p"), F.min("kind").alias("kind"), F.max_by("tokens", F.struct("n", "name")).alias("tokens"), F.sum("n").alias("n")).drop("kind_p"))

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(x, k) for x, t in zip(b["node"], b["tokens"]) for k in _suffixes(list(t), least)], columns=["node", "key"])

    def again(keyed: DataFrame, most: int, grow: Callable[[str, list[str], str, int], Iterable[str]]) -> DataFrame:
        """(node, key): with the keys that ``grow`` gives in the place of those that over ``most`` values share."""
        counted = keyed.join(keyed.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > most), "key", "left")
        kept, many = counted.where("c is null").select("node", "key"), counted.where("c is not null").join(nodes.select("node", "tokens"), "node")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame([(x, g) for x, t, k, c in zip(b["node"], b["tokens"], b["key"], b["c"]) for g in grow(x, list(t), k, c)], columns=["node", "key"])

        return cut(kept.unionByName(many.select("node", "tokens", "key", "c").mapInPandas(run, "node string, key string")).distinct())

    keys = cut(nodes.select("node", "tokens").mapInPandas(suffixes, "node string, key string"))
    keys = again(keys, common, lambda x, t, k, c: _refined(t, least, k))
    keys = again(keys, crowded, lambda x, t, k, c: _narrowed(t, least, k))
    keys = again(keys, crowded, lambda x, t, k, c: _spread(x, k, c, crowded))
    pairs = keys.select(F.col("node").alias("a"), "key").join(keys.select(F.col("node").alias("b"), "key"), "key").where("a < b").select("a", "b").distinct()
    full = nodes.select("node", "kind", "tokens", "n")
    both = pairs.join(full.select(F.col("node").alias("a"), F.col("kind").alias("ka"), F.col("tokens").alias("ta"), F.col("n").alias("na")), "a").join(full.select(F.col("node").alias("b"), F.col("kind").alias("kb"), F.col("tokens").alias("tb"), F.col("n").alias("nb")), "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = [same(list(x), list(y), p, q) for x, y, p, q in zip(b["ta"], b["tb"], b["ka"], b["kb"])]
            whole = lambda col: [sum(len(t) > 1 for t in x) * 100 + min(99, sum(map(len, x))) for x in b[col]]
            out = pd.DataFrame({"a": b["a"], "b": b["b"], "na": b["na"], "nb": b["nb"], "fa": whole("ta"), "fb": whole("tb"), "score": s})
            yield out[out["score"] > 0]

    # an exchange of so few bytes would be merged into a task or two
    both = both.repartition(max(8, values.sparkSession.sparkContext.defaultParallelism))
    scored = cut(both.mapInPandas(compare, "a string, b string, na long, nb long, fa int, fb int, score double"))
    ends = scored.selectExpr("a as x", "b as y", "na as nx", "nb as ny", "fa as fx", "fb as fy", "score").unionByName(scored.selectExpr("b as x", "a as y", "nb as nx", "na as ny", "fb as fx", "fa as fy", "score"))
    rank_x = F.struct(F.expr("least(3, fx div 100)").alias("w"), F.col("nx").alias("n"), F.col("fx").alias("f"), F.col("x").alias("v"))
    rank_y = F.struct(F.expr("least(3, fy div 100)").alias("w"), F.col("ny").alias("n"), F.col("fy").alias("f"), F.col("y").alias("v"))
    up = ends.where(rank_y > rank_x)
    strong = up.where("score >= 0.75").groupBy("x").agg(F.max_by("y", F.struct("score", rank_y)).alias("parent"))
    roots = _roots(cut(nodes.select("node").join(strong.withColumnRenamed("x", "node"), "node", "left").select("node", F.coalesce("parent", "node").alias("parent"))))
    # weak values: only where everything that fits is one entity
    weak = (
        up.where("score < 0.75")
        .join(strong.select("x"), "x", "left_anti")
        .join(roots.select(F.col("node").alias("y"), F.col("root")), "y")
        .groupBy("x")
        .agg(F.count_distinct("root").alias("fits"), F.min("root").alias("to"))
        .where("fits = 1")
        .select(F.col("x").alias("w"), "to")
    )
    entity = roots.join(weak, roots["root"] == weak["w"], "left").select("node", F.coalesce("to", "root").alias("entity"))
    return people.select("name", node.alias("node")).join(entity, "node").select("name", "entity")


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest of parent pointers, by pointer doubling: as many rounds as the depth's logarithm."""
    current = parents.select("node", F.col("parent").alias("root"))
    while True:
        following = cut(current.alias("c").join(current.select(F.col("node").alias("m"), F.col("root").alias("next")), F.col("c.root") == F.col("m")).select("node", "root", "next"))
        moved = following.where("root != next").limit(1).count()
        current = following.select("node", F.col("next").alias("root"))
        if not moved:
            return current


def name_pairs(linked: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b in byte order: all pairs of spellings of one entity, for results that must name each."""
    left, right = linked.select(F.col("name").alias("name_a"), "entity"), linked.select(F.col("name").alias("name_b"), "entity")
    return left.join(right, "entity").where("name_a < name_b").select("name_a", "name_b").distinct()
