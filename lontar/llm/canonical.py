"""Problem 2: mapping free-entered values to a canonical list.

Distinct values are normalised into parts (breadcrumb steps), every part retrieves entries of the reference list through an inverted
index of character n-grams, entries are scored by the weighted cosine, and the best one is accepted above a threshold and a margin
to the next other entry. Of several accepted parts the most specific one counts. Values without an accepted part are reported with
entry 0.

The reference list is enriched before indexing: names, translated names, known synonyms, shortened forms (prefixes, as values get cut
off), and labels known to name no entry, which compete for candidates like entries do.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lontar.llm.names import near
from lontar.session import cut, small_side

#: Synonyms of Indonesian and English news sections, by canonical name.
SECTION_SYNONYMS = {
    "Politik": ["parlemen", "pemilu", "pilkada", "politics"],
    "Hukum dan Kriminal": ["hukrim", "kriminalitas", "kriminal", "meja hijau", "hukum", "crime", "law"],
    "Ekonomi dan Bisnis": ["ekbis", "bisnis", "perekonomian", "ekonomi", "business", "economy"],
    "Keuangan": ["finansial", "perbankan", "bursa saham", "finance"],
    "Olahraga": ["sport", "sports", "cabang olahraga"],
    "Sepak Bola": ["bola", "liga bola", "soccer", "football"],
    "Bulu Tangkis": ["raket", "tepok bulu", "badminton"],
    "Ilmu Pengetahuan": ["sains", "iptek", "riset ilmiah", "science"],
    "Teknologi": ["tekno", "gawai", "digital gadget", "technology"],
    "Perangkat Lunak": ["software apps", "software", "aplikasi"],
    "Kesehatan": ["medis", "sehat", "health"],
    "Pendidikan": ["edukasi", "sekolah", "kampus", "education"],
    "Lingkungan Hidup": ["lh", "ekologi", "alam iklim", "lingkungan", "environment"],
    "Hiburan": ["selebritas", "showbiz", "entertainment"],
    "Musik": ["tangga lagu", "konser lagu", "music"],
    "Perfilman": ["film", "bioskop", "sinema", "movies"],
    "Otomotif": ["oto", "kendaraan", "mobil motor", "automotive"],
    "Wisata dan Kuliner": ["travelling", "plesiran", "jalan jalan", "wisata", "kuliner", "travel"],
    "Mancanegara": ["dunia", "internasional", "luar negeri", "world"],
    "Daerah": ["kedaerahan", "nusantara", "regional", "regional daerah"],
    "Gaya Hidup": ["lifestyle tren", "lifestyle", "life style", "gaya"],
    "Properti": ["perumahan", "hunian", "rumah properti", "property", "real estate"],
    "Pertanian": ["agri", "agribisnis", "tani", "agriculture"],
    "Kebudayaan": ["budaya", "tradisi", "seni budaya", "culture"],
}
#: Labels of page furniture and content kinds that name no section.
SECTION_NONE = [
    "arsip", "indeks", "semua", "terkini", "terbaru", "terpopuler", "populer", "berita utama", "utama", "pilihan editor", "editorial", "lainnya", "lain lain", "uncategorized", "umum",
    "podcast", "galeri foto", "foto", "video", "iklan baris", "iklan", "siaran pers", "surat pembaca", "opini", "kolom", "rubrik", "halaman", "tag", "cat", "id", "test", "tbd", "n a", "news", "berita",
    "home", "beranda", "kanal", "headline", "redaksi", "advertorial",
]
#: Words around a section's name that say nothing about which section it is.
NOISE = {"berita", "kanal", "rubrik", "info", "home", "beranda", "news", "terkini", "utama", "populer", "terpopuler", "kategori", "category", "section"}
#: First words of technical labels; what follows is not a section.
LABELS = {"tag", "cat", "id", "halaman", "page", "kolom"}
#: Scores of inexact matches with forms other than names count so much less.
LESS_SURE = 0.92
#: Words that join parts of a name.
JOINERS = {"dan", "and", "n", "amp"}
_DIGITS = str.maketrans("013457@$", "oieastas")


def words(part: str) -> list[str]:
    """The words of one part: look-alike digits inside words read as letters, words without a letter and joining words left out."""
    out = []
    for w in re.findall(r"[^\W_]+(?:[@$][^\W_]+)*", part):
        if any(c.isalpha() for c in w):
            core = w.rstrip("0123456789") if re.fullmatch(r"[^\W\d_]{3,}\d+", w) else w
            w = (core or w).translate(_DIGITS)
        if any(c.isalpha() for c in w) and w not in JOINERS:
            out.append(w)
    return out


def parts(value: str) -> list[str]:
    """The steps of a value, each as its words joined by spaces, noise words left out where others remain."""
    s = html.unescape(html.unescape(value))
    s = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", s) if s.startswith("#") else s
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").lower()
    out = []
    for step in re.split(r"[/>|»›:;,•·→\\]+|\s[–—-]\s", s):
        w = words(step)
        kept = [x for x in w if x not in NOISE]
        if len(kept) == len(w) and len(w) > 1:  # a misspelt noise word at either end
            ends = [x for i, x in enumerate(w) if not ((i == 0 or i == len(w) - 1) and len(x) >= 4 and any(near(x, n) for n in NOISE))]
            kept = ends or kept
        if kept or w:
            out.append(" ".join(kept or w))
    return out


def grams(s: str) -> dict[str, float]:
    """Weighted character n-grams of a phrase without its spaces: letters, pairs at most one letter apart, and triples.

    Neighbours and pairs that skip a letter count alike, so swapped, doubled and missing letters leave most n-grams in place.
    """
    p = "^" + s.replace(" ", "") + "$"
    out: dict[str, float] = defaultdict(float)
    for i in range(len(p) - 1):
        out["2" + p[i : i + 2]] += 1.0
        if i + 3 <= len(p):
            out["2" + p[i] + p[i + 2]] += 0.8
            out["3" + p[i : i + 3]] += 0.5
    for c in p[1:-1]:
        out["1" + c] += 0.7
    return out


@dataclass
class Index:
    """An inverted index of n-grams over the enriched reference list."""

    entry: np.ndarray
    trust: np.ndarray
    parent: dict[int, int]
    idf: dict[str, float]
    postings: dict[str, tuple[np.ndarray, np.ndarray]] = field(repr=False)

    def best(self, phrase: str, threshold: float, margin: float) -> tuple[int, float]:
        """The accepted entry and its score; entry 0 where none is accepted."""
        g = grams(phrase)
        q = {k: w * self.idf.get(k, self.idf[""]) for k, w in g.items()}
        norm = math.sqrt(sum(w * w for w in q.values())) or 1.0
        score = np.zeros(len(self.entry))
        for k, w in q.items():
            if k in self.postings:
                at, weight = self.postings[k]
                score[at] += w * weight
        score /= norm
        score = np.where(score > 0.999, 1.0, score * self.trust)
        top = int(np.argmax(score))
        first, best = float(score[top]), int(self.entry[top])
        others = score[self.entry != best]
        second = float(others.max()) if len(others) else 0.0
        return (best, first) if first >= threshold and first - second >= margin else (0, first)


def shortened(phrase: str) -> Iterator[str]:
    """Prefixes a value may be cut off to: at least four letters, not the whole."""
    flat = phrase.replace(" ", "")
    for n in range(4, len(flat)):
        yield flat[:n]


def build_index(reference: list[tuple[int, str, str | None]], synonyms: dict[str, list[str]] | None = None, none: list[str] | None = None, parents: dict[int, int] | None = None) -> Index:
    """The index over (entry, name, translated name); entries of ``none`` stand for entry 0."""
    synonyms = SECTION_SYNONYMS if synonyms is None else synonyms
    forms: dict[tuple[int, str], float] = {}
    for entry, name, other in reference:
        for n in (name, other):
            for flat in [" ".join(words(p)) for p in [unicodedata.normalize("NFKD", n or "").lower()]]:
                if flat:
                    forms[entry, flat] = 1.0
                    for short in shortened(flat):
                        forms.setdefault((entry, short), LESS_SURE)
        for s in synonyms.get(name, []):
            forms.setdefault((entry, s), LESS_SURE)
        joined = re.sub(r"[^a-z]", "", (name or "").lower())  # with its joining words
        forms[entry, joined] = 1.0
    for s in SECTION_NONE if none is None else none:
        forms.setdefault((0, s), LESS_SURE)
    keys = list(forms)
    vectors = [grams(f) for _, f in keys]
    df: dict[str, int] = defaultdict(int)
    for v in vectors:
        for k in v:
            df[k] += 1
    n = len(vectors)
    idf = {k: math.sqrt(math.log(2 + n / c)) for k, c in df.items()}
    idf[""] = math.sqrt(math.log(2 + n))
    lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
    for i, v in enumerate(vectors):
        w = {k: x * idf[k] for k, x in v.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for k, x in w.items():
            lists[k].append((i, x / norm))
    postings = {k: (np.array([i for i, _ in x]), np.array([w for _, w in x])) for k, x in lists.items()}
    return Index(np.array([e for e, _ in keys]), np.array(list(forms.values())), parents or {}, idf, postings)


def resolve(value: str, index: Index, threshold: float, margin: float) -> tuple[int, float]:
    """The entry a value means and its score; entry 0 where none fits. Of several, one whose parent is also named, else the last."""
    steps = parts(value)
    if steps and steps[0].split()[0] in LABELS:
        return 0, 0.0
    found = [(e, s) for e, s in (index.best(p, threshold, margin) for p in steps) if e]
    if not found:
        return 0, 0.0
    entries = {e for e, _ in found}
    below = [x for x in found if index.parent.get(x[0]) in entries]
    return (below or found)[-1]


def map_values(values: DataFrame, reference: DataFrame, value_col: str = "category", threshold: float = 0.5, margin: float = 0.05, synonyms: dict[str, list[str]] | None = None, none: list[str] | None = None, parents: dict[int, int] | None = None, max_reference: int = 100_000) -> DataFrame:
    """(value, category_id, score) of every distinct value that is neither null nor blank.

    ``reference`` has category_id, name and name_en; rows with a null id or name are left out, of a repeated name the smallest id
    counts. A value equal to a name maps to that entry. The index goes to the executors, so a list of over ``max_reference`` entries
    is refused with an error rather than broadcast. An empty reference maps everything to 0; an empty table gives no rows.
    """
    entries = reference.select(F.col("category_id").cast("int").alias("i"), F.col("name").alias("n"), F.col("name_en").alias("e")).where("i is not null and n is not null").groupBy("n").agg(F.min("i").alias("i"), F.min_by("e", "i").alias("e"))
    rows = entries.limit(max_reference + 1).collect()
    if len(rows) > max_reference:
        raise ValueError(f"the reference list has over {max_reference} entries")
    spark = values.sparkSession
    named = {r.n: r.i for r in rows}
    index = spark.sparkContext.broadcast(build_index(sorted((r.i, r.n, r.e) for r in rows), synonyms, none, parents) if rows else None)
    names = spark.sparkContext.broadcast(named)

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix, exact = index.value, names.value
        for b in batches:
            out = [(exact[v], 1.0) if v in exact else resolve(v, ix, threshold, margin) if ix is not None else (0, 0.0) for v in b["value"]]
            yield pd.DataFrame({"value": b["value"], "category_id": [e for e, _ in out], "score": [s for _, s in out]})

    # so few bytes would be merged into a task or two
    tasks = max(8, spark.sparkContext.defaultParallelism)
    distinct = values.select(F.col(value_col).cast("string").alias("value")).where(F.col("value").rlike("[^\\s\\xa0\\u2000-\\u200a\\u202f\\u205f\\u3000]")).distinct()
    return distinct.repartition(tasks, "value").mapInPandas(match, "value string, category_id int, score double")


#: Parents among the canonical news sections: the more specific section counts when both are named.
SECTION_PARENTS = {"Keuangan": "Ekonomi dan Bisnis", "Sepak Bola": "Olahraga", "Bulu Tangkis": "Olahraga", "Perangkat Lunak": "Teknologi", "Musik": "Hiburan", "Perfilman": "Hiburan"}


def map_records(records: DataFrame, reference: DataFrame, id_col: str = "article_id", value_col: str = "category", **how) -> DataFrame:
    """(id, value, category_id) of every record whose value is neither null nor blank; repeated rows stay repeated.

    The mapping of distinct values is broadcast only if its counted rows allow; else values are joined by shuffle, where a value that
    very many records hold is split by the skew handling of adaptive execution.
    """
    ids = {r.name: r.category_id for r in reference.where(F.col("name").isin([*SECTION_PARENTS, *SECTION_PARENTS.values()])).groupBy("name").agg(F.min("category_id").alias("category_id")).collect()}
    how.setdefault("parents", {ids[a]: ids[b] for a, b in SECTION_PARENTS.items() if a in ids and b in ids})
    mapped = small_side(map_values(records, reference, value_col, **how).select("value", "category_id"))
    return records.select(F.col(id_col).alias("id"), F.col(value_col).cast("string").alias("value")).join(mapped, "value").select("id", "value", "category_id")


def report(mapped: DataFrame) -> DataFrame:
    """(value, category_id, n): distinct values with their entry and number of records, unmatched ones with entry 0."""
    return cut(mapped).groupBy("value", "category_id").agg(F.count("*").alias("n"))
