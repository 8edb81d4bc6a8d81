"""Problems 1, 2, 3, 4, 7, 8 and 9."""

import base64
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lontar.llm import canonical, mixing, names, residue, sourcelines, subjects, tokens


# 1: names


def test_names_of_one_entity(spark):
    groups = [
        ["Benyamin Kumgemunpir Tosreseh", "BENYAMIN KUMGEMUNPIR TOSRESEH", "Tosreseh, Benyamin Kumgemunpir", "Beni Kumgemunpir Tosreseh", "B. Kumgemunpir Tosreseh", "Benyamin Kumgemunpir T.", "Oleh: Benyamin Kumgemunpir Tosreseh", "Benyamin Kumgemnupir Tosreseh", "Bényamin Kumgemunpir Tosreseh, S.Sos.", "benyaminkumgemunpirtosreseh"],
        ["Kantor Berita Sandyakala", "KB Sandyakala", "Sandyakala (Kantor Berita)", "SANDYAKALA", "Kantor Berita Sandyakal"],
        ["Redaksi Warta Lintang", "Tim Redaksi Warta Lintang", "Warta Lintang / Redaksi", "redaksi wartalintang"],
    ]
    alone = ["Hapsari Rolnelodeh", "Redaksi", "Admin", "-", "", "Benyamin Kumgemunpir Tosreseh dan Hapsari Rolnelodeh", None]
    rows = [(n, "x") for g in groups for n in g] + [(n, "x") for n in alone] + [(groups[0][0], "x")] * 5
    linked = names.link_names(spark.createDataFrame(rows, "author_name string, name string"))
    got = {(r.name_a, r.name_b) for r in names.name_pairs(linked).collect()}
    want = {tuple(sorted(p, key=lambda s: s.encode())) for g in groups for p in itertools.combinations(g, 2)}
    assert got == want


def test_ambiguous_initials_belong_to_nobody(spark):
    rows = [(n,) for n in ("Hapsari Sosjunonis", "Herlambang Sosjunonis", "H. Sosjunonis")]
    assert names.name_pairs(names.link_names(spark.createDataFrame(rows, "author_name string"))).count() == 0


def test_common_suffixes_are_refined_not_lost(spark):
    rng = random.Random(2)
    last = [f"{a}{b}dulas" for a in ("kumge", "rolne", "tosre", "benka") for b in ("ra", "to", "mi", "se")]
    people = [f"Nama{chr(97 + i)}ro {x}" for i, x in enumerate(last)]
    typo = {p: p[:-7] + p[-6:] for p in people}
    rows = [(x,) for p in people for x in (p, typo[p])]
    rng.shuffle(rows)
    got = {(r.name_a, r.name_b) for r in names.name_pairs(names.link_names(spark.createDataFrame(rows, "author_name string"), common=3)).collect()}
    assert {tuple(sorted((p, t))) for p, t in typo.items()} <= got


def test_refined_suffixes_link_what_the_plain_ones_do(spark):
    rng = random.Random(5)
    word = lambda k: "".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(k))
    rows = ["L. Kogiwejis", "Leonardus Korgiwejis", "M. Rawejis", "Murtini Rawejis", "Kantor Berita Tawejis", "KB Tawwejis"]
    for _ in range(40):
        first, middle, last = word(3), word(2), word(rng.choice([1, 1, 2, 3])) + "dulas"
        k = rng.randrange(1, len(last) - 5)
        typo = last[:k] + rng.choice("xyz") + last[k + 1 :]
        rows += [f"{first} {last}", f"{first[0]}. {last}", f"{first[0]}. {typo}", f"{first[1:]} {typo}", f"{first} {middle} {last}", f"{first} {middle[0]}. {typo}", f"{last}, {first}", f"{first}{last}", f"{first[:4]} {typo}"]
    d = spark.createDataFrame([(x,) for x in rows], "author_name string")
    plain, refined = ({(r.name_a, r.name_b) for r in names.name_pairs(names.link_names(d, common=c)).collect()} for c in (10**9, 0))
    assert refined == plain and {("L. Kogiwejis", "Leonardus Korgiwejis"), ("M. Rawejis", "Murtini Rawejis"), ("KB Tawwejis", "Kantor Berita Tawejis")} <= plain


def test_short_tokens_and_single_tokens_are_indexed(spark):
    """Names of short tokens only, tokens written together, and short agency names under a suffix that is common."""
    rows = ["Dewi Ayu", "Dewi Ayu Sri", "DEWI AYU", "dewiayusri", "Kantor Berita Abcwita", "KB Abcwitaa"] + [f"Kantor Berita {a}{b}wita" for a in "defghijk" for b in "mnopqrst"]
    d = spark.createDataFrame([(x,) for x in rows], "author_name string")
    for common in (200, 3):
        got = {(r.name_a, r.name_b) for r in names.name_pairs(names.link_names(d, common=common)).collect()}
        assert {("Dewi Ayu", "Dewi Ayu Sri"), ("DEWI AYU", "Dewi Ayu Sri"), ("Dewi Ayu Sri", "dewiayusri"), ("KB Abcwitaa", "Kantor Berita Abcwita")} <= got


def test_a_crowded_block_is_narrowed_and_spread(spark):
    """Thousands of values that share a suffix and the beginning of another token; slips are linked, and no block stays crowded."""
    rng = random.Random(12)
    word = lambda k: "".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(k))
    people = sorted({f"Bud{word(2)} {word(2)}santoso" for _ in range(3000)})
    slips = {p: p[:4] + p[5:] for p in people[::100]}
    d = spark.createDataFrame([(x,) for x in people + list(slips.values())], "author_name string")
    got = {(r.name_a, r.name_b) for r in names.name_pairs(names.link_names(d, common=50, crowded=100)).collect()}
    assert {tuple(sorted(x)) for x in slips.items()} <= got
    tokens = [names.parse(p)[1] for p in people]
    blocks = {}
    for t in tokens:
        for k in names._narrowed(t, 5, "ntoso<bud"):
            blocks[k] = blocks.get(k, 0) + 1
    assert max(blocks.values()) < len(people) / 2
    pairs = [set(names._spread(str(i), "k", 500, 100)) for i in range(500)]
    assert all(a & b for a in pairs[:50] for b in pairs) and max(sum(k in p for p in pairs) for k in pairs[0]) < 350


def test_no_names(spark):
    assert names.link_names(spark.createDataFrame([], "author_name string")).count() == 0


def test_lcs_against_table():
    def slow(a, b):
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        return t[-1, -1]

    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(12))) for _ in range(2))
        assert names.lcs_length(a, b) == slow(a, b)


# 2: canonical values

REF = [(1, "Politik", "Politics"), (2, "Hukum dan Kriminal", "Law and Crime"), (5, "Olahraga", "Sports"), (6, "Sepak Bola", "Football"), (12, "Pendidikan", "Education"), (17, "Otomotif", "Automotive")]
VALUES = {"Politik": 1, "poltiik": 1, "PARLEMEN": 1, "Hukum & Kriminal": 2, "hukum-dan-kriminal": 2, "Hukum dan Krim…": 2, "#HukumdanKriminal": 2, "Olahraga / Sepak Bola": 6, "Sepak Bola / Olahraga": 6, "Kanal Pendidikan": 12, "Ot0mot1f": 17, "Home > Otomotif": 17, "Arsip": 0, "Tag: Kumgejars": 0, "-": 0, "Pendidíkan ": 12, "cat_123": 0}


def test_values_map(spark):
    rows = [(i, v) for i, v in enumerate(VALUES)] + [(98, None), (99, "  ")]
    d = spark.createDataFrame(rows, "article_id long, category string").withColumn("value", F.lit("clash"))
    ref = spark.createDataFrame(REF, "category_id int, name string, name_en string")
    got = {r.value: r.category_id for r in canonical.map_records(d, ref).collect()}
    assert got == VALUES
    assert canonical.map_records(d.limit(0), ref).count() == 0
    assert {r.category_id for r in canonical.map_records(d, ref.limit(0)).collect()} == {0}
    with pytest.raises(ValueError):
        canonical.map_values(d, ref, max_reference=2)
    assert sum(r.n for r in canonical.report(canonical.map_records(d, ref)).collect()) == len(VALUES)


# 3: residue


def test_residue(spark):
    rng = random.Random(3)
    nouns, verbs = ["dinas kesehatan", "tim peneliti", "kepala sekolah", "pelaku pasar", "komunitas skuter"], ["membahas anggaran daerah", "mengukur kadar gula", "memulai latihan pramusim", "menahan harga beras"]
    prose = lambda: f"{rng.choice(nouns).capitalize()} {rng.choice(verbs)} di Kota Sawones pada {rng.randint(1, 28)} Maret 2031."
    rows = [(i, f"Kabar {rng.choice(nouns)}", "\n".join(prose() for _ in range(8))) for i in range(300)]
    bad = {1000: ("Kabar", prose() + " Biaya untuk {{ article.lead }} naik."), 1001: ("502 Bad Gateway", "Peladen sedang sibuk. Silakan coba beberapa saat lagi."), 1002: ("Kabar", prose() + "\nLorem ipsum dolor sit amet consectetur adipiscing elit."), 1003: ("Kabar", "You need to enable JavaScript to run this app."), 1004: ("${headline}", prose()), 1005: ("Kabar", prose() + "\nkjg wlledfyt hflqjdla jaa usrajfs wwg ddlghkyk hjkasd. skl argjsdd skl jjlffgtl ihllasg sjy.\nqjtg gse aftasr gdjllaw yahjf sai kwhkgu gkhia aheul jpg feid fskd.")}
    good = {2000: ("Kabar", prose() + " Buku panduan karya Sawo memuat contoh ${author} dan %JUDUL% pada halaman 12."), 2001: ("Kabar", prose() + " Istilah lorem ipsum dibahas Sawo pada kelas desain di Kota Sawones."), 2002: (None, None), 2003: ("", ""), 2004: ("Kabar", prose() * 2000)}
    d = spark.createDataFrame(rows + [(k, *v) for k, v in (bad | good).items()], "article_id long, title string, content_text string").withColumn("kinds", F.lit("clash"))
    got = {r.id: r for r in residue.find_residue(d).collect()}
    assert set(got) == set(bad)
    assert got[1003].covered > 0.5 > got[1000].covered > 0
    assert residue.find_residue(d, coverage=0.5).count() < len(bad)
    assert residue.without_residue(d).count() == d.count() - len(bad)
    assert residue.find_residue(d.limit(0)).count() == 0
    long = prose() * 300
    pieces = list(residue.lines_of("a", "\n".join([long, "b", long]), 1000))
    assert "".join(pieces) == "\n".join(["", "a", long, "b", long, ""]) and len(pieces) > 2 and all(p.endswith("\n") for p in pieces)


# 4: repeated lines


def brute_lines(rows):
    import re
    from collections import Counter, defaultdict

    norm = lambda s: re.sub(r"\s+", " ", re.sub("[0-9]", "", s.lower())).strip()
    n, c = Counter(s for _, s, _ in rows), defaultdict(set)
    for i, s, t in rows:
        for x in (t or "").split("\n") if t is not None else []:
            if any(ch.isalpha() for ch in norm(x)):
                c[s, norm(x)].add(i)
    return {(i, k + 1) for i, s, t in rows if t is not None for k, x in enumerate(t.split("\n")) if any(ch.isalpha() for ch in norm(x)) and len(c[s, norm(x)]) >= max(5, 0.02 * n[s])}


def test_lines_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        s = rng.choice(["a", "a", "a", "b", None])
        own = [f"isi {rng.randrange(10**6)} kata{rng.randrange(500)}" for _ in range(3)]
        own += rng.sample(["Baca juga berita", "Dibagikan 12 kali", "dibagikan 99  KALI\r", "***", f"jarang {i % 90}x", ""], 3)
        rng.shuffle(own)
        rows.append((i, s, "\n".join(own)))
    rows += [(900, "a", None), (901, "b", ""), (902, "c", "Baca juga berita\n" * 50)]
    d = spark.createDataFrame(rows, "article_id long, source_id string, content_text string").withColumn("line", F.lit(1)).withColumn("source", F.lit("clash"))
    rep = sourcelines.repeated_lines(d)
    assert {(r.id, r.line_no) for r in sourcelines.occurrences(d, rep).collect()} == brute_lines(rows)
    assert {(r.id, r.line_no) for r in sourcelines.repeated_places(d).collect()} == brute_lines(rows)
    assert sourcelines.repeated_places(d.limit(0)).count() == 0
    left = {r.id: r.text for r in sourcelines.without_lines(d, rep).collect()}
    gone = brute_lines(rows)
    assert left[900] is None and all(left[i] == "\n".join(x for k, x in enumerate(t.split("\n"), 1) if (i, k) not in gone) for i, _, t in rows if t is not None)
    assert sourcelines.repeated_lines(d.limit(0)).count() == 0


def test_summaries_never_undercount_beyond_their_error():
    rng = np.random.default_rng(1)
    items = np.minimum(rng.zipf(1.3, 20_000), 5000).astype(np.int64)
    parts = []
    for chunk in np.array_split(items, 7):
        h = sourcelines.HeavyHitters()
        for small in np.array_split(chunk, 5):
            h.add(*np.unique(small, return_counts=True), 60)
        parts.append(h)
    err = sum(h.error for h in parts)
    for x, true in zip(*np.unique(items, return_counts=True)):
        est = sum(int(h.counters[h.items == x].sum()) for h in parts)
        assert est <= true <= est + err


# 7: tokens

ODD = ["", None, "Halo dunia, apa kabar?", "<|endoftext|> a", "​﻿x\u0000y\r\n\t z", "naïve 漢字かな 🇮🇩👍🏽 привет", "a" * 5000, "don't we'll I'M", "  spasi   banyak  \n\n", "١٢٣ ½ ²", "\ud83d" if False else "é"]


def test_ids_equal_a_public_encoder(spark):
    tiktoken = pytest.importorskip("tiktoken")
    path = tokens.vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    public = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    d = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r.id: list(r.ids) for r in tokens.encode_column(d).collect()}
    assert got == {i: public.encode_ordinary(t or "") for i, t in enumerate(ODD)}
    rng = random.Random(9)
    enc = tokens.encoder(path)
    for _ in range(300):
        t = "".join(rng.choice("abc de\nÉ漢👍1.' ") for _ in range(rng.randrange(60)))
        assert enc.encode(t) == public.encode_ordinary(t)
    assert tokens.encode_column(d.limit(0)).count() == 0
    big = spark.createDataFrame([(None, "a"), (2**60 + 1, None)], "doc_id long, text string")
    assert {r.id for r in tokens.encode_column(big).collect()} == {None, 2**60 + 1}


def test_perfect_hash_is_minimal():
    d = {f"k{i}".encode(): i for i in range(3000)}
    h = tokens.PerfectHash(d)
    assert None not in h.keys and len(h.keys) == 3000
    assert all(h.get(k) == v for k, v in d.items()) and h.get(b"stranger") == -1
    assert tokens.PerfectHash({}).get(b"x") == -1


# 8: mixing


def test_knapsack_against_enumeration():
    rng = random.Random(4)
    for _ in range(150):
        n = [rng.randint(1, 9) for _ in range(4)]
        c = [rng.randint(0, 3) for _ in n]
        b, over = rng.randint(0, 40), rng.randint(0, 5)
        take = mixing.knapsack(n, c, b, over)
        s = sum(x * y for x, y in zip(take, n))
        reach = {sum(x * y for x, y in zip(t, n)) for t in itertools.product(*[range(k + 1) for k in c])}
        best = min((abs(x - b), x > b) for x in reach if x <= b + over)
        assert all(t <= k for t, k in zip(take, c)) and (b == 0 or (abs(s - b), s > b) == best)


def test_mixture_keeps_its_promises(spark):
    rng = random.Random(6)
    rows = [(i, rng.randint(1, 400), rng.choice("aaaab")) for i in range(600)] + [(700, 0, "a"), (701, None, "a"), (702, 5, None), (703, 9, "z"), (704, 50, "c")]
    sized = spark.createDataFrame(rows, "id long, tokens long, source string")
    goals = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 3), ("c", 0.05, 4), ("none", 0.05, 2)], "source string, target_share double, max_repeats int")
    for total in (None, 20_000, 10**7):
        uses, report = mixing.mix(sized, goals, total)
        u = uses.collect()
        most = {"a": 1, "b": 3, "c": 4}
        assert len({r.id for r in u}) == len(u) and all(1 <= r.uses <= most[r.source] for r in u)
        for r in report.collect():
            mine = sum(x.uses * x.tokens for x in u if x.source == r.source)
            assert mine == r.used_tokens and r.short_tokens == max(0, r.target_tokens - mine)
            if total == 20_000 and r.source in "ab":
                assert abs(mine - r.target_tokens) <= 1
            if total == 10**7 and r.documents:
                assert mine == r.available_tokens * r.max_repeats
    empty = mixing.mix(sized.limit(0), goals)
    assert empty[0].count() == 0 and empty[1].count() == 4


# 9: subjects

PHRASES = {"hukum": ["vonis banding", "surat dakwaan", "permohonan kasasi"], "musik": ["album kedua", "konser akustik", "lagu tema"], "sains": ["teleskop radio", "sel punca", "reaksi katalis"]}
FILL = ["Jalan menuju Kota {0} sempat padat selama {1} menit.", "Cuaca di {0} pada Minggu dilaporkan berawan.", "Pertemuan lanjutan direncanakan {1} Maret oleh {0}."]


def _documents(n, seed):
    rng = random.Random(seed)
    called = lambda: "".join(rng.choice("ABCDE")) + "".join(rng.choice("aeioumnrst") for _ in range(7))
    out = []
    for i in range(n):
        own = rng.choice([["hukum"], ["musik"], ["sains"], ["hukum", "musik"], []])
        s = [f"Biaya untuk {rng.choice(PHRASES[o])} diperkirakan {rng.randint(1, 99)} juta, kata {called()}." for o in own for _ in range(4)]
        s += [rng.choice(FILL).format(called(), rng.randrange(60)) for _ in range(3)]
        if own and rng.random() < 0.3:
            other = rng.choice([o for o in PHRASES if o not in own])
            s += [f"Selain {rng.choice(PHRASES[other])}, warga menunggu kabar dari {called()}."] if len(s) > 6 else []
        rng.shuffle(s)
        out.append((i, " ".join(s), f"src{i % 3}", own))
    return out


def test_subjects_on_held_out_documents(spark):
    docs = _documents(700, 8)
    rng = random.Random(1)
    labels = [(i, o if rng.random() > 0.05 else rng.choice(list(PHRASES)), "a1") for i, _, _, own in docs[:400] for o in own]
    areas = spark.createDataFrame([(s, s + "_en", "") for s in PHRASES], "subject string, name_en string, description string")
    d = spark.createDataFrame([r[:3] for r in docs] + [(9000, None, None), (9001, "", "x"), (9002, "   ", "x")], "doc_id long, text string, source string").withColumn("subject", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(0, "HUKUM_en", None), (None, "hukum", "a"), (1, "tidak ada", "a")], "doc_id long, subject string, annotator string")
    model = subjects.train(d, lab, areas)
    got = {}
    for r in subjects.assign(d, model).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    right = sum(got.get(i, set()) == set(own) for i, _, _, own in docs[400:])
    assert right >= 0.95 * 300 and not {9000, 9001, 9002} & set(got)
    assert sum(r.documents for r in subjects.makeup(subjects.assign(d, model)).collect()) == sum(map(len, got.values()))


def test_subjects_without_labels(spark):
    areas = spark.createDataFrame([("hukum", "law", "")], "subject string, name_en string, description string")
    d = spark.createDataFrame([(1, "Isi teks.", "s")], "doc_id long, text string, source string")
    model = subjects.train(d, spark.createDataFrame([], "doc_id long, subject string, annotator string"), areas)
    assert subjects.assign(d, model).count() == 0


def test_sentences_and_initials():
    assert subjects.sentences('Kata W. Mesberitos di Kota. "Jujur saja," tutur A. B. Sawo.\nBaris pen﻿ularan') == ["Kata W. Mesberitos di Kota.", '"Jujur saja," tutur A. B. Sawo.', "Baris penularan"]
    assert subjects.sentences(None) == []


def test_furniture_is_counted_over_all_documents_by_source(spark):
    """Lines that the labelled documents don't reveal are furniture of their source, and of no other."""
    docs = _documents(400, 8)
    lines = [f"Lini {w} mengundang pembaca ke saluran pesan." for w in ("satu", "dua", "tiga", "empat", "lima", "enam", "tujuh", "delapan", "sembilan", "sepuluh", "sebelas", "belasan")]
    body = ["Surat dakwaan dibacakan kemarin sore.", "Jalan menuju kota sempat padat.", "Cuaca dilaporkan berawan."]
    rows = [r[:3] for r in docs]
    rows += [(1000 + i, "\n".join([f"Warga {'abcdefgh'[i]}wira menunggu kabar.", *body, *lines]), "kecil") for i in range(8)]
    rows += [(2000, "\n".join([*body, *lines]), "lain"), (2001, "\n".join(lines[:1]), None)] + [(2010 + i, f"Kabar {'abcdefgh'[i]}tama.", "lain") for i in range(8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("hash", F.lit("clash"))
    found = subjects.find_furniture(d)
    held = lambda source, s: subjects._hashes([subjects._shape(s)])[0] in found.get(source, [])
    assert all(held("kecil", s) for s in lines) and "lain" not in found and None not in found
    areas = spark.createDataFrame([(s, s + "_en", "") for s in PHRASES], "subject string, name_en string, description string")
    lab = spark.createDataFrame([(i, o, "a1") for i, _, _, own in docs for o in own], "doc_id long, subject string, annotator string")
    model = subjects.train(d, lab, areas)
    kept = subjects._kept([subjects.sentences(rows[400][1]), subjects.sentences(rows[408][1])], ["kecil", "lain"], model.sentence.furniture)
    assert kept[0] == ["Warga awira menunggu kabar."] and len(kept[1]) == 15
