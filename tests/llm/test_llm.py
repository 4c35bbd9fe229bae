"""The training-data operators on known cases, against brute force and against public libraries."""

import os
import random
from functools import partial

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pedalmill.llm.address import parse, with_parts
from pedalmill.llm.components import connected_components
from pedalmill.llm.edit import BKTree, damerau, plain
from pedalmill.llm.mixture import blocks_of, draw_shards, mix, permute, plan_slots, token_offsets
from pedalmill.llm.names import cluster_names, differ, pairs_within, settle
from pedalmill.llm.reference_map import map_to_reference
from pedalmill.llm.residue import _EMPTIES, _NOTICES, _SAMPLES, find_residue, strong_reasons
from pedalmill.llm.same_address import cluster_addresses, shingles, signature
from pedalmill.llm.similar import jaro_winkler, lost_letters
from pedalmill.llm.tokenizer import VOCABULARY, Tokenizer, read_ranks, with_ids
from pedalmill.llm.vocabulary import vocabulary

words = st.text("abc?", max_size=7)
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")


class TestEdit:
    @settings(max_examples=300, deadline=None)
    @given(words, words, words)
    def test_a_metric(self, a, b, c):
        assert (damerau(a, b) == 0) == (a == b) and damerau(a, b) == damerau(b, a)
        assert damerau(a, c) <= damerau(a, b) + damerau(b, c)

    def test_known(self):
        assert [damerau(*p) for p in (("ca", "abc"), ("ab", "ba"), ("", "xy"), ("kitten", "sitting"))] == [2, 1, 2, 3]

    @settings(max_examples=100, deadline=None)
    @given(st.lists(words, max_size=40), words, st.integers(0, 3))
    def test_tree_finds_all(self, entries, word, most):
        assert BKTree(entries).search(word, most) == sorted((damerau(word, e), e) for e in set(entries) if damerau(word, e) <= most)

    def test_jaro_winkler(self):
        assert jaro_winkler("MARTHA", "MARHTA") == pytest.approx(0.9611, abs=1e-4) and jaro_winkler("a", "") == 0 and jaro_winkler("", "") == 1


PROVINCES = [(1, "Vạn Thạch"), (1, "V.Thạch"), (10, "Đông Phố"), (10, "Phố Đông"), (12, "Thạch Lâm"), (15, "Phượng Hải"), (24, "Tịnh Hòa"), (37, "Ia Tuyn"), (51, "Hà Lam"), (52, "Hà Lãng"), (61, "Vĩnh Sầm"), (8, "Bạch Thủy"), (44, "BLAU")]
NAMES = frozenset(plain(n).replace(" ", "").replace(".", "") for _, n in PROVINCES)
READ = partial(parse, names=NAMES, dotted=frozenset({"vthach"}))

ADDRESSES = [
    ("số 71 Đ. Bửu Mạnh, Xã Thạch Lâm, H. Thục Chè, Tỉnh Vĩnh Sầm đt 0100307888", 61, "71", ("buu", "manh")),
    ("Vạn Thạch (cũ), nay là Tỉnh Hà Lam", 51, "", ()),
    ("63 đ. Vò Xuân – P. Cẩm Cúc – Bạch Thủy (cũ), nay là Hà Lam", 51, "63", ("vo", "xuan")),
    ("so 13, xom Nghiem Manh, P. Nguyen Luong, T. Dong Pho (truoc thuoc Ha Lam)", 10, "13", ("nghiem", "manh")),
    ("TINH HALANG; 46/2 phố Xá Phổ", 52, "46/2", ("xa", "pho")),
    ("xã Thục Quốc H. Nhiếp Khuê 94b Bách Nghè Ia Tuy", 37, "94B", ("bach", "nghe")),
    ("12 Xóm Kênh, phường 012, huyện Yên, V.Thạch", 1, "12", ("xom", "kenh")),
    ("Kho: 5, đường Loan Lộc, Ph?ợng Hải", 15, "5", ("loan", "loc")),
    ("P. Ngọc, SN 7 Phố Kỳ Xá, Tinh Hoa", 24, "7", ("ky", "xa")),
    ("Số 23 Đ. Trấn Triệu, Port Ellery, Norvania", None, "23", ("tran", "trieu")),
    ("như trên", None, "", ()), ("", None, "", ()), ("   ", None, "", ()), (None, None, "", ()),
    ("9 đường Loan Lộc, TP. BLAU", 44, "9", ("loan", "loc")),
    ("x" * 50_000, None, "", ()),
]


class TestMapping:
    def test_parts(self):
        for text, _, number, street in ADDRESSES:
            got = READ(text)
            assert (got.number, got.street) == (number, street), text

    def test_address_after_a_phone_number(self):
        for text in ("ĐT: 0905123456, 12 phố Cúc Chương, T. Hà Lam", "12 phố Cúc Chương tel 0905 123 456\nT. Hà Lam", "Tel: (0905) 123-456 - 12 phố Cúc Chương, Hà Lam đơn 2 dòng 5 chiếc", "12 phố Cúc Chương, Hà Lam ĐT: 0100459544 Tổng 9 mã, 34 xe,", "12 phố Cúc Chương, Hà Lam đt 0100459544 (9 món / 3 xe)", "Tel 0905123456 12 phố Cúc Chương, Hà Lam"):
            got = READ(text)
            assert (got.number, got.street, got.phrases) == ("12", ("cuc", "chuong"), [("ha lam", "T." in text)]), text

    @pytest.mark.parametrize("shard", [20_000, 3])
    def test_ids_whatever_the_shards(self, spark, shard):
        rows = spark.createDataFrame([(i, a[0], "clash") for i, a in enumerate(ADDRESSES)] + [(0, ADDRESSES[0][0], "twice")], "i int, address string, entry string")
        ref = spark.createDataFrame([*PROVINCES, (None, "x"), (9, None)], "id int, name string")
        got = map_to_reference(with_parts(rows, "address", READ), "address", "phrases", ref, ["i"], shard_entries=shard, block_values=4).select("i", "entry", "match.id").collect()
        assert len(got) == len(ADDRESSES) + 1
        assert {r.i: r.id for r in got} == {i: a[1] for i, a in enumerate(ADDRESSES)}

    def test_empty(self, spark):
        rows = spark.createDataFrame([], "address string")
        none = spark.createDataFrame([], "id int, name string")
        assert map_to_reference(with_parts(rows, "address", READ), "address", "phrases", none, ["address"]).count() == 0
        one = map_to_reference(with_parts(spark.createDataFrame([("Hà Lam",)], "address string"), "address", READ), "address", "phrases", none, ["address"])
        assert one.first().match is None

    @pytest.mark.parametrize("shard", [20_000, 100])
    def test_repeated_and_long_entries(self, spark, shard):
        """Copies of one entry crowd none out, and an entry may have any number of words."""
        long = "Cong Hoa Dan Chu Nhan Dan Ba Mien Lon"
        names = [f"Kem {a}{b}o" for a in "bcdghklm" for b in "aeiou"]
        ref = spark.createDataFrame([(7, long)] + [(5, "Vinh Sam")] * 400 + [(100 + i, n) for i, n in enumerate(names)], "id int, name string")
        rows = spark.createDataFrame([(long.lower(), 7), (long.replace("Ba", "Bb"), 7), ("vinh samm", 5), *((n, 100 + i) for i, n in enumerate(names))], "v string, want int")
        asked = rows.withColumn("phrases", F.array(F.struct(F.lower("v").alias("text"), F.lit(False).alias("marked"))))
        got = map_to_reference(asked, "v", "phrases", ref, ["want"], shard_entries=shard, block_values=10).select("v", "want", "match.id").collect()
        assert len(got) == len(names) + 3 and [(r.v, r.id) for r in got if r.id != r.want] == []


class TestComponents:
    def test_brute_force(self, spark):
        rng = random.Random(2)
        links = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(45)] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(30)] + [("a", "a"), ("b", None), ("n01", "n02"), ("n01", "n02")]
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "src string, dst string")).collect()}
        boss = {}

        def find(x):
            while boss.setdefault(x, x) != x:
                x = boss[x]
            return x

        for a, b in links:
            if b and a != b:
                x, y = sorted((find(a), find(b)))
                boss[y] = x
        nodes = {x for a, b in links if b and a != b for x in (a, b)}
        assert got == {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}

    def test_empty(self, spark):
        assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


class TestVocabulary:
    def test_brute_force(self, spark):
        rng = random.Random(19)
        words = ["".join(rng.choice("abn?") for _ in range(rng.randrange(1, 6))) for _ in range(150)]
        rows = [([rng.choice(words) for _ in range(rng.randrange(4))], rng.choice([1, 1, 2, 30])) for _ in range(150)] + [([], 1), (None, 5), (["ab", "ba"], 40), (["abba", "nn"], 3)]
        n, beside = {}, {}
        for ws, t in rows:
            for i, w in enumerate(ws or []):
                n[w] = n.get(w, 0) + t
                if i + 1 < len(ws):
                    beside[w, ws[i + 1]] = beside.get((w, ws[i + 1]), 0) + t
        slips = {a: sorted(b for b in n if b != a and n[b] >= 8 * n[a] and (len(a) > 1 or len(b) > 1) and damerau(a, b) == 1 and (len(a) < 3 or jaro_winkler(a, b) >= 0.7)) for a in n}
        lost = {a: sorted(b for b in n if "?" not in b and lost_letters(a, b) <= 1) if "?" in a and not slips[a] else [] for a in n}
        base = {a for a in n if n[a] >= 2 and not slips[a] and not lost[a]}
        for r in vocabulary(spark.createDataFrame(rows, "w array<string>, t int"), "w", "t").collect():
            a = r.word
            assert r.n == n[a] and list(r.spellings) == (slips[a] or lost[a] or [a])
            cuts = [] if slips[a] or lost[a] else [(a[:k], a[k:]) for k in range(2, len(a) - 1) if a[:k] in base and a[k:] in base and (n[a] < 2 or beside.get((a[:k], a[k:]), 0) >= n[a])]
            assert list(r.halves) == (list(max(cuts, key=lambda c: (min(n[c[0]], n[c[1]]), c[0]))) if cuts else [])
            assert r.known == (a in base and not r.halves)

    def test_rare_words_of_a_large_vocabulary_are_known(self, spark):
        """What a word is does not depend on how many others there are."""
        few = [["kimbra", "zoltan"], ["kimbra", "zoltan"], ["kimbra", "oruk"], ["zoltan", "oruk"], ["kimbrra", "zoltan"]] + [["kimbra"]] * 8
        many = [[f"{a}{b}{c}{d}{e}" for e in "xyzqw"] for a in "bcdfg" for b in "hjkl" for c in "mnpqr" for d in "stvwxyzbcd"] * 2
        many += [[w * 2 for w in ws] for ws in many] + [[w[::-1] * 2 for w in ws] for ws in many] + [[w + "uuuu" for w in ws] for ws in many]
        told = []
        for lists in (few, few + many):
            df = spark.createDataFrame([(ws, 1) for ws in lists], "w array<string>, t int")
            told.append({r.word: tuple(r) for r in vocabulary(df, "w", "t").collect()})
        assert len(told[1]) >= 20_000 and {w: told[1][w] for w in told[0]} == told[0]
        assert told[0]["oruk"][2] and told[0]["kimbrra"][3] == ["kimbra"] and sum(i[2] for i in told[1].values()) >= 20_000


DEALERS = [
    ("A1", "CÔNG TY TNHH THƯƠNG MẠI Nga Bách Khiêm Nhung"), ("A2", "NGA BACH KHIEM NHUNG MANUFACTURING JSC"), ("A3", "Nhung Khiêm, Bách Nga - CTY. CP S.X"), ("A4", "Xe đạp anh Nga (Bách Khiêm Nhung)"),
    ("A5", "Ông Nga - Bách Khiêm Nhung Nga"), ("A6", "KH: Cty Ngabách Khiêm Nhung"), ("A7", "H.K.D Nga Bácch Khiêm Nhug"), ("A8", "ct tnhh nga b?ch khiêm nhung"),
    ("B1", "CTY TNHH Nga Bách Kim Nhung"), ("B2", "Hộ KD Kim Nhung Nga Bách"), ("C1", "Khách lẻ"), ("C2", ""), ("C3", "  "), ("C4", None), ("C5", "."), ("D1", "Công ty TNHH"), ("L1", "x" * 100_000), ("L2", "Nga Bách " * 5000),
]
#: Other names, so that the syllables are known.
FILL = [(f"F{i}", " ".join(c)) for i, c in enumerate([("Nga", "Bách", "Loan", "Kim"), ("Khiêm", "Nhung", "Trấn", "Loan"), ("Bách", "Khiêm", "Trấn", "Kim"), ("Nhung", "Nga", "Trấn", "Loan")] * 6)]


class TestNames:
    def test_variants(self, spark):
        rows = spark.createDataFrame([(a, b, "clash") for a, b in DEALERS + FILL + DEALERS[:1]], "code string, name string, dealer string")
        got = {}
        for r in cluster_names(rows, "code", "name").collect():
            got.setdefault(r.dealer, set()).add(r.code)
        by = {c: g for g in got.values() for c in g}
        assert by["A1"] == {f"A{i}" for i in range(1, 9)} and by["B1"] == {"B1", "B2"}
        assert not {"C1", "C2", "C3", "C4", "C5", "D1", "L1"} & set(by) and by["L2"] == {"L2"}

    def test_nicknames_and_size(self, spark):
        rows = [("N1", "Nguyễn Loan Kim"), ("N2", "Ng. Loan Kim"), ("N3", "Cty TNHH Kim Ng Loan"), ("N4", "Tr. Loan Kim"), ("E1", "Robert Mill"), ("E2", "Mill, Bob"), ("E3", "Roberta Mill"), ("T1", "Loan Kim Nga Bách Trấn"), ("T2", "Kim Nga Bách Trấn Loan")] + FILL
        rows += [("F", "Nguyễn Nga"), ("F", "Robert Bách"), ("F", "Roberta Nga"), ("F", "Mill Nga")]
        df = spark.createDataFrame(rows, "code string, name string")
        got = {r.code: r.dealer for r in cluster_names(df, "code", "name").collect()}
        assert got["N1"] == got["N2"] == got["N3"] != got["N4"] and got["E1"] == got["E2"] != got["E3"] and got["T1"] == got["T2"]
        plainly = {r.code: r.dealer for r in cluster_names(df, "code", "name", nicknames={}).collect()}
        assert plainly["N1"] != plainly["N2"] and plainly["E1"] != plainly["E2"]
        four = {r.code: r.dealer for r in cluster_names(df, "code", "name", 4).collect()}
        assert four["T1"] != four["T2"]  # other windows of four

    def test_every_link_counts(self, spark):
        known = frozenset("nga loan kim lan".split())
        own = {"n1": "nga loan kimm", "n2": "nga loan kiim", "n3": "nga loan kkim", "n4": "nga loan kym", "c": "kim loan nga", "s": "kim loann nga", "u": "kim lan nga", "v": "kim laan nga", "w": "lan loanx kkim", "x": "lan loann kkim", "y": "lan kim loam"}  # nothing known stands against w-x-y
        own = {k: v.split() for k, v in own.items()}
        scores = [("n1", "n2", 0.99), ("n3", "n4", 0.99), ("n1", "n3", 0.9), ("s", "c", 0.9), ("s", "u", 0.8), ("v", "u", 0.9), ("s", "v", 0.7), ("w", "x", 0.99), ("x", "y", 0.9)]
        rows = [(a, own[a], b, own[b], b not in "cu", sorted(known & {*own[a], *own[b]}), s) for a, b, s in scores]
        df = spark.createDataFrame(rows, "a string, own_a array<string>, b string, own_b array<string>, slip_b boolean, sure array<string>, score double")
        got = {}
        for r in settle(df, differ).collect():
            got.setdefault(r.component, set()).add(r.node)
        assert sorted(map(sorted, got.values())) == [["c", "s"], ["n1", "n2", "n3", "n4"], ["u", "v"], ["w", "x", "y"]]
        assert settle(df.limit(0), differ).count() == 0

    def test_pairs(self, spark):
        m = spark.createDataFrame([("b", "g"), ("a", "g"), ("a", "g"), ("c", "g"), ("d", None), (None, "g"), ("e", "h")], "code string, g string")
        assert sorted(tuple(r) for r in pairs_within(m, "code", "g").collect()) == [("a", "b"), ("a", "c"), ("b", "c")]

    def test_empty_and_all_null(self, spark):
        assert cluster_names(spark.createDataFrame([], "code string, name string"), "code", "name").count() == 0
        assert cluster_names(spark.createDataFrame([("x", None)], "code string, name string"), "code", "name").count() == 0


def places(spark, rows):
    read = with_parts(spark.createDataFrame(rows, "code string, address string, province int"), "address", READ)
    return cluster_addresses(read, "code", "province", "number", "mark", "words")


class TestAddresses:
    def test_streets_that_begin_alike(self, spark):
        texts = ["12 Nguyễn Thị Minh Khai, Hà Lam", "12 Nguyễn Thị Định, Hà Lam", "5 đường Cách Mạng Tháng Tám, Hà Lam", "5 đường Cách Mạng, Hà Lam"]
        assert [READ(t).street for t in texts] == [("nguyen", "thi", "minh", "khai"), ("nguyen", "thi", "dinh"), ("cach", "mang", "thang", "tam"), ("cach", "mang")]
        assert all(READ(t).phrases == [("ha lam", False)] for t in texts)
        got = {r.code: r.place for r in places(spark, [(f"{t}|{k}", t, 51) for t in texts for k in range(3)]).collect()}
        assert len(got) == 12 and len(set(got.values())) == 4 and all(got[f"{t}|0"] == got[f"{t}|2"] for t in texts)

    def test_places(self, spark):
        same = ["Số 12 đường Loan Lộc, Hà Lam", "12, Đ. LOAN LOC, P. 5, Hà Lam", "Hà Lam - sn 12 Loan Lộcc", "12 phố Loanlộc, Hà Lam"]
        other = ["12A đường Loan Lộc, Hà Lam", "12 đường Lộc Loan, Hà Lam", "12 đường Loan Kim, Hà Lam", "Loan Lộc, Hà Lam", "", None]
        fill = [f"{i} đường {a}, Hà Lam" for i, a in enumerate(["Loan Kim", "Lộc Kim", "Kim Loan", "Kim Lộc", "Lộc Loan"] * 4, 100)]
        rows = [(f"S{i}", a, 51) for i, a in enumerate(same)] + [(f"O{i}", a, 51) for i, a in enumerate(other)] + [("P0", same[0], 52), ("N0", same[0], None)] + [(f"F{i}", a, 51) for i, a in enumerate(fill)]
        got = {}
        for r in places(spark, rows).collect():
            got.setdefault(r.place, set()).add(r.code)
        by = {c: g for g in got.values() for c in g}
        assert by["S0"] == {"S0", "S1", "S2", "S3"}
        assert all(by[c] == {c} for c in ("O0", "O1", "O2", "P0")) and not {"O3", "O4", "O5", "N0"} & set(by)

    def test_whole_street(self, spark):
        texts = {
            "219, phn Niệm Nghna, Xn Xuân nịnh, Tỉnh Hà Lam": ("niem", "nghna"), "12 nnnng Loan Lộc, Hà Lam": ("loan", "loc"), "12 đường Loan Lộc Kim, Hà Lam": ("loan", "loc", "kim"), "12 Loan Lộc Kim Hà Lãng": ("loan", "loc", "kim"),
            "9 thôn Loan Lộc xn Kim Nga huyện Trấn Kim, Hà Lam": ("loan", "loc"), "xã Kim H. Nga 5 phố Sen Chè Đông Phố": ("sen", "che"), "7 Truyen Xa, Ha Lam": ("truyen", "xa"), "7 Loan": ("loan",),
        }
        for text, street in texts.items():
            assert READ(text).street == street, text
        same, other = ["12 phố Loan Lộc, Hà Lam", "12, phn Loan Lộc, Hà Lam", "12 phpo Loan Lộc, Hà Lam"], ["12 phố Loan Lộc Kim, Hà Lam", "12 phố Loan Lộc Trấn, Hà Lam"]
        fill = [f"{i} đường {a}, Hà Lam" for i, a in enumerate(["Loan Kim", "Lộc Trấn", "Kim Loan", "Trấn Lộc"] * 4, 100)]
        rows = [(a, a, 51) for a in same + other + fill]
        got = {r.code: r.place for r in places(spark, rows).collect()}
        assert len({got[a] for a in same}) == 1 and len({got[a] for a in same[:1] + other}) == 3

    def test_signatures_meet(self):
        rng = random.Random(1)
        sy = "loan kim nghe truong quoc khuynh bach nga suoi tre".split()
        met = total = 0
        for _ in range(300):
            w = [rng.choice(sy), rng.choice(sy)]
            k = rng.randrange(2)
            p = rng.randrange(len(w[k]))
            v = list(w)
            v[k] = w[k][:p] + rng.choice("xyz") + w[k][p + 1 :]
            a, b = (signature(shingles(x, lambda s: (s,))) for x in (w, v))
            total += 1
            met += any(x == y for x, y in zip(a, b, strict=True))
        assert met / total > 0.98

    def test_empty(self, spark):
        assert places(spark, []).count() == 0


@needs_vocabulary
class TestTokenizer:
    def test_against_public_libraries(self):
        tiktoken = pytest.importorskip("tiktoken")
        with open(VOCABULARY, "rb") as f:
            ranks = read_ranks(f.read())
        from pedalmill.llm.tokenizer import PATTERN

        theirs = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        mine = Tokenizer(ranks)
        rng = random.Random(9)
        texts = ["", " ", "a", "Đường Sậy\r\n  26\"", "é é", "<|endoftext|>", "🚲👨‍👩‍👧", "x" * 20_000, "ab" * 5000, "0123456789" * 300]
        for _ in range(600):
            low, high = rng.choice([(32, 126), (0xA0, 0x17F), (0x1EA0, 0x1EF9), (0x4E00, 0x9FFF), (0x1F300, 0x1F6FF)])
            texts.append("".join(chr(rng.choice((32, 32, rng.randint(low, high)))) for _ in range(rng.randrange(60))))
        for t in texts:
            assert mine.encode(t) == theirs.encode_ordinary(t)
            assert mine.decode(mine.encode(t)) == t

    def test_decode_of_broken_bytes(self):
        with open(VOCABULARY, "rb") as f:
            t = Tokenizer(read_ranks(f.read()))
        for data in (b"\xff", b"\xe2\x82", b"a\xc3", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xe2\x28\xa1"):
            assert t.decode([t.machine.ranks[bytes([b])] for b in data]) == data.decode("utf-8", "replace")

    def test_rows(self, spark):
        df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "hello", "k"), (3, "hello", "k")], "i int, text string, ids string")
        got = sorted((r.i, r.ids) for r in with_ids(df, "text", ["i"]).collect())
        assert got[:2] == [(1, []), (2, [])] and got[2] == got[3] and len(got[2][1]) > 0
        assert with_ids(df.limit(0), "text", ["i"]).count() == 0


@needs_vocabulary
class TestMixture:
    def test_permutation(self):
        import numpy as np

        for n in (1, 2, 3, 17, 64, 1000):
            got = permute(np.arange(n), np.full(n, n), np.full(n, 12345))
            assert sorted(got) == list(range(n))

    def test_plan(self):
        plans = plan_slots([("a", 0.5, 1), ("b", 0.3, 4), ("none", 0.2, 9)], {"a": 10_000, "b": 2_000}, block=100)
        a, b, none = plans
        assert none.slots == 0 and a.slots <= a.blocks and b.slots <= 4 * b.blocks
        assert a.slots / (a.slots + b.slots) == pytest.approx(0.625, abs=0.02)
        drawn = draw_shards(plans, 3, shard_slots=10)
        for p in plans:
            mine = [(f, n) for _, s, f, n in drawn if s == p.source]
            assert sum(n for _, n in mine) == p.slots and all(f == sum(n for _, n in mine[:i]) for i, (f, _) in enumerate(mine))
        assert draw_shards([], 1) == []

    def test_whole(self, spark):
        rng = random.Random(4)
        docs = [(i, rng.choice("aaab"), " ".join(rng.choice(["xe", "đạp", "số"]) for _ in range(rng.randrange(1, 40)))) for i in range(200)] + [(900, "a", None), (901, "a", ""), (902, None, "x"), (903, "zzz", "x"), (None, "a", "x")]
        df = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id bigint, source string, text string, ids string")
        goals = spark.createDataFrame([("a", 0.6, 1), ("b", 0.4, 3), ("c", 0.2, 1), (None, 0.1, 1), ("b", 0.9, 9)], "source string, target_share double, max_repeats int")
        m, plans = mix(df, goals, block=32, chunks=8)
        rows = m.collect()
        uses = {}
        for r in rows:
            uses[r.source, r.block] = uses.get((r.source, r.block), 0) + 1
            assert r.n_tokens == len(r.ids) <= 32
        cap = {"a": 1, "b": 3}
        assert rows and all(n <= cap[s] for (s, _), n in uses.items())
        tokens = {s: sum(r.n_tokens for r in rows if r.source == s) for s in "ab"}
        assert tokens["a"] / sum(tokens.values()) == pytest.approx(0.6, abs=0.05)
        assert len({(r.source, r.slot) for r in rows}) == len(rows) == sum(p.slots for p in plans)
        # blocks hold every token of their source once, in the order of the offsets
        placed = token_offsets(with_ids(df.where("source = 'a' and doc_id is not null"), "text", ["doc_id", "source"]), chunks=8)
        whole = [i for r in sorted(placed.collect(), key=lambda r: r.start) for i in r.ids]
        assert [i for r in sorted(blocks_of(placed, 32).collect(), key=lambda r: r.block) for i in r.ids] == whole

    def test_empty(self, spark):
        docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
        goals = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
        assert mix(docs, goals)[0].count() == 0 and mix(docs, goals.limit(0))[0].count() == 0


RESIDUE = [
    ("Kính gửi {{ ten }}, đơn <số lượng>", ["FIELD"]), ("Dear %(name)s", ["FIELD"]), ("Giá: $kho$", ["FIELD"]), ("Bảo hành đến {0}.", ["FIELD"]), ("giao ngày (điền giá vào đây)", ["FIELD"]), ("đặt XX/XX/XXXX", ["FIELD"]),
    ("hỏi cỡ bánh {20, 24, 26} rồi mới báo giá", []), ("Lưu ý mẫu thư: chỗ ${ten sp} phải được thay bằng tên thật trước khi gửi.", []), ("Our form prints [YOUR COMPANY] when the field is blank; please fix the form.", []),
    ("Dear null, your order [object Object] is on its way.", ["EMPTY_VALUE"]), ("Giá: NaN đồng, còn undefined chiếc.", ["EMPTY_VALUE"]), ("Khách phàn nàn là chuông lỏng, mong được đổi.", []),
    ("Lorem ipsum dolor magna velum.", ["FILLER"]), ("abc abc abc abc abc abc", ["FILLER"]), ("Heading 1\nHeading 2", ["FILLER"]), ("Bản in còn sót đoạn lorem ipsum ở trang cuối, in lại giúp.", []), ("Bài test tải trọng: lần 1 đạt, lần 2 đạt, lần 3 đạt.", []),
    ("404 Not Found", ["NOTICE"]), ("Xe đạp\n503 Service Unavailable - upstream closed\nHotline", ["NOTICE"]), ("Please enable JavaScript to continue", ["NOTICE"]), ("请启用 JavaScript 后重试", ["NOTICE"]), ("Verifying you are human…", ["NOTICE"]),
    ('Traceback (most recent call last):\nFile "a.py", line 3, in main', ["NOTICE"]), ('Khi bấm gửi đơn thì web hiện "500 Internal Server Error", nhờ anh chị nhập giúp.', []), ('A dealer quoted the message "Oops. Access denied." and asked whether the order went through.', []),
    ('Khách gửi ảnh màn hình có dòng "Traceback (most recent call last): File "a.py", line 3, in main KeyError: \'x\'", nhờ kỹ thuật xem giúp.', []), ("Trang đặt hàng báo lỗi 404 từ sáng, bên tôi phải gửi đơn qua thư này.", []), ("Shelf 404 holds the samples.", []),
    (None, []), ("", []), (" \n ", []), ("ok", []), ("a" * 100_000, []),
]


class TestResidue:
    def test_reasons(self):
        for text, want in RESIDUE:
            assert strong_reasons(text) == want, text

    def test_general_words_hide_nothing(self):
        for text in ("Thông tin chuyển khoản: {{bank_account}}", "Xin chúc mừng {{name}}", "Ký hiệu: {{invoice_symbol}}", 'Khách hàng: "{{name}}"', "Thông tin chung\nTên: “${name}”"):
            assert strong_reasons(text) == ["FIELD"], text
        for text in ("Please enable JavaScript so we can show the prices.", "The page you want has been removed last week."):
            assert strong_reasons(text) == ["NOTICE"], text
        for text in ("Nhớ giữ nguyên ký hiệu {{ten}} để máy tự điền.", "Đại lý hỏi vì sao thư in chữ {{ten}}, đã báo kỹ thuật sửa mẫu.", 'Thư gửi đi còn nguyên dòng "{{ten}}", nhờ xem giúp.'):
            assert strong_reasons(text) == [], text

    def test_other_languages_and_words_in_brackets(self):
        for text in ("Página no encontrada", "Seite nicht gefunden", "ページが見つかりません", "Please enable cookies to continue", "La página solicitada no existe.", "Страница не найдена", "Bitte aktivieren Sie JavaScript", "503 Ошибка"):
            assert strong_reasons(text) == ["NOTICE"], text
        for text in ("Your card [Visa] has been charged", "Order 12 confirmed. Please log in to see the invoice.", "[Update] giá mới"):
            assert strong_reasons(text) == [], text

    def test_sieve_finds_what_the_pattern_finds(self):
        rng = random.Random(23)
        parts = [t for t, _ in RESIDUE if t and len(t) < 500]
        for pattern in (_NOTICES, _SAMPLES, _EMPTIES):
            assert pattern.literals
            for _ in range(2000):
                t = plain(rng.choice(parts))
                i = rng.randrange(len(t) + 1)
                t = t[i:] + " " + t[:i] if rng.random() < 0.5 else t
                assert pattern.search(t) == bool(pattern.pattern.search(t)), t

    def test_rows(self, spark):
        """A body shared under many titles is residue only where its words are those of known residue."""
        seeds = [(300 + i, f"Xe số {i}\nRất tiếc, trang này không tồn tại, mời bạn quay lại {w}", "shop") for i, w in enumerate("sau ngay mai nhé".split())]
        pages = [(100 + i, f"Xe {c} màu đỏ\nRất tiếc, mời bạn quay lại", "web") for i, c in enumerate("abc")] + [(200, "Tin nhắn\nRất tiếc, mời bạn quay lại", "mail")]
        chats = [(400 + i, f"Hỏi {c} giá\nok anh nhé, em báo kho", "web") for i, c in enumerate("abcdef")] + [(500 + i, f"Hàng {i % 6}\nDạ vâng {'abcdefghij'[i // 6]}", "chat") for i in range(60)]
        df = spark.createDataFrame([(i, t, "h") for i, (t, _) in enumerate(RESIDUE)] + seeds + pages + chats + [(0, RESIDUE[0][0], None)], "doc_id bigint, text string, source string").withColumn("reasons", F.lit("clash"))
        got, evidence = {}, {}
        for r in find_residue(df, "doc_id", "text", "source").collect():
            got.setdefault(r.doc_id, []).append(r.reasons)
            evidence[r.doc_id] = (r.host, r.mismatched, r.titles)
        want = {i: [w] for i, (_, w) in enumerate(RESIDUE) if w} | {i: [["NOTICE"]] for i, _, _ in seeds} | {100 + i: [["DUPLICATED"]] for i in range(3)}
        want[0] = [["FIELD"], ["FIELD"]]
        assert got == want and evidence[100] == ("web", True, 3) and evidence[300] == ("shop", True, 1)
        assert find_residue(df.limit(0), "doc_id", "text", "source").count() == 0
