"""Pieces, personal data, SimHash and quality rules against the library or brute force, and their edge cases."""

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest
import sentencepiece as spm
import xxhash
from pyspark.sql import functions as F

from quern.llm import pieces, pii, quality_rules, simhash
from quern.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", " ", "  a", "a  b   ", "▁x ▁", "日本 語\n\n\tx", "\0a", "😀 é̀", "▁▁▁▁▁", "a" * 3000, " " * 50 + "z", "x\xa0y", "�", "\r\n ", "ab" * 30 + " c"]


def docs_of(spark, texts, **more):
    rows = [(i, t, more.get("lang", "en"), more.get("source", "s"), None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.model_blob(tokenizer_path()))


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=tokenizer_path())


def test_ids_and_text_equal_the_library_on_odd_texts(model, library):
    rng = random.Random(1)
    made = ["".join(rng.choices("ab e\n▁é日😀.,#  ", k=rng.randrange(1, 120))) for _ in range(300)]
    for text in ODD + made:
        ids, source = model.encode(text)
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == want
        assert model.decode(ids) == library.decode(want)
        spans = model.spans(text, ids, source)
        if text:
            assert spans[-1, 1] == len(text.encode())
            assert (spans[1:, 0] == spans[:-1, 1]).all()


def test_merging_one_by_one_and_many_at_once_agree(model):
    rng = random.Random(2)
    words = ["▁" + "".join(rng.choices("theraionéß日.!", k=rng.randrange(1, 39))) for _ in range(400)]
    import numpy as np

    assert [np.frombuffer(b, "<u4").tolist() for b in model.merge_many(words)] == [model.merge(w) for w in words]


def test_decoding_of_any_ids_equals_the_library(model, library):
    rng = random.Random(3)
    import numpy as np

    for _ in range(200):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), 1, 2]) for _ in range(rng.randrange(1, 12))]
        assert model.decode(np.array(ids, "<u4")) == library.decode(ids), ids


def test_character_map_follows_the_longest_prefix_and_keeps_the_alignment():
    rule = spm.SentencePieceNormalizer(rule_name="nmt_nfkc")
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(rule.serialized_model_proto())
    charmap = pieces.CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    own = pieces.PieceModel.__new__(pieces.PieceModel)
    spec = proto.normalizer_spec
    own.map, own.dummy, own.squeeze = charmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces
    for text in ["ﬁne ①②", "ｶﾞ x", "é", "ＡＢＣ", "㌔", "a​b", "plain"]:
        form, source = own.normalize(text)
        want = rule.normalize(text)
        assert form == want
        assert len(source) == len(form.encode()) + 1 and source[-1] == len(text.encode())
        assert list(source) == sorted(source)
    own.squeeze = own.dummy = True
    form, source = own.normalize("  ﬁ   x ")
    assert form == "▁fi▁x" and source[3] == 2 and len(source) == len(form.encode()) + 1


def test_pieces_of_null_and_empty_texts(spark):
    out = pieces.digest_documents(docs_of(spark, [None, "", "a b"]).withColumn("ids_sha256", F.lit(7)), tokenizer_path())
    rows = {r["doc_id"]: r for r in out.collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert rows[0]["n_tokens"] == rows[1]["n_tokens"] == 2 and rows[0]["decoded_sha256"] == nothing
    assert len(rows[2]["ids_sha256"]) == 64
    assert pieces.encode_documents(docs_of(spark, []), tokenizer_path()).count() == 0


def test_op1_equals_the_library(spark, library):
    want = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op1_sentencepiece"](spark, SF).collect():
        ids = library.encode(want[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# personal data


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and plain_luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    bits = ["a@b.c", "x@", "@y.z", "_p@q.r.s", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100", "+12", "é", " ", ".", "-", "12", "+", "@", "a.b-c%d", "\n", "000255.0.0.1"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randrange(1, 9)))
        assert [x[:3] for x in pii.spans_of(text) if x[1] < 4] == plain_spans(text), text


def test_long_runs_take_time_in_proportion():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "AB12" + "A1" * 90_000):
        pii.spans_of(text)


def test_checksums_and_context():
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    kinds = lambda t: [pii.KINDS[x[1]] for x in pii.spans_of(t)]
    assert "iban" in kinds("account GB82 WEST 1234 5698 7654 32 now") and "iban" not in kinds("account GB82 WEST 1234 5698 7654 33")
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    near, far = pii.spans_of("call +1 212 555 0100")[0][3], pii.spans_of("version +1 212 555 0100")[0][3]
    assert near > far
    assert pii.redact("me a@b.co or a@b.co!") == "me [EMAIL] or [EMAIL]!"
    assert pii.redact(None) is None and pii.redact("") == "" and pii.redact("clean") == "clean"


def test_account_numbers_end_where_their_country_says():
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    for number in (de, de.replace(" ", ""), gb):
        for behind in ("", ".", " BIC COBADEFFXXX", " EUR 500", " 500", " A", f" {gb} X", "\n12"):
            text = f"IBAN {number}{behind}"
            assert (5, 4, 5 + len(number)) in [x[:3] for x in pii.spans_of(text)], text
            assert number not in pii.redact(text)
    assert pii.redact(f"IBAN {de} {gb} {de} BIC") == "IBAN [IBAN] [IBAN] [IBAN] BIC"
    assert pii.redact(f"AB12 {de} EUR") == "AB12 [IBAN] EUR"
    odd = "XX" + next(f"{k:02}" for k in range(2, 99) if pii.mod97(f"XX{k:02}ABCD12345678901")) + "ABCD12345678901"
    assert pii.redact(f"account {odd} now") == "account [IBAN] now"
    for text in (f"{de}1", f"{gb}x", f"x{gb}", de[:-1] + "1 EUR 500", de[:-3] + " EUR 500"):
        assert not any(x[1] == 4 for x in pii.spans_of(text)), text


def test_personal_data_on_tables(spark):
    df = docs_of(spark, [None, "", "a@b.co", "a@b.co"]).withColumn("pii_spans", F.lit(1))
    got = pii.find_personal_data(df).orderBy("doc_id").collect()
    assert [len(r["pii_spans"]) for r in got] == [0, 0, 1, 1]
    red = pii.redacted_documents(docs_of(spark, [None, "", "a@b.co é"])).orderBy("doc_id").collect()
    assert [(r["text"], r["n_chars"]) for r in red] == [(None, None), ("", 0), ("[EMAIL] é", 9)]
    assert pii.find_personal_data(docs_of(spark, [])).count() == 0


def test_op4_equals_the_plain_patterns(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    names = ("email", "ip", "card", "phone")
    for r in QUERIES["op4_pii"](spark, SF).collect():
        spans = plain_spans(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in names] == [sum(s[1] == i for s in spans) for i in range(4)]
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


# SimHash


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(prints, ids, radius=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for i in range(len(prints)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(len(prints))]


def test_every_four_bits_are_outside_some_mask():
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    rng = random.Random(5)
    for _ in range(5000):
        bits = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not (m & bits) for m in masks)


@pytest.mark.parametrize("bucket", [4096, 8])
def test_links_and_components_equal_brute_force(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "MAX_BUCKET", bucket)
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = random.Random(6)
    prints = []
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 14)):
            prints.append(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "_q_fp long")
    roots = {r["_q_fp"]: r["root"] for r in simhash.fingerprint_roots(df).collect()}
    got = [roots.get(p, p) for p in signed]
    want = plain_components(prints, signed)
    assert got == want


def test_op8_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_print(r["text"]) for r in docs]
    want = plain_components(prints, [r["doc_id"] for r in docs])
    got = {r["doc_id"]: r for r in QUERIES["op8_simhash"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r, p, c in zip(docs, prints, want, strict=True):
        assert got[r["doc_id"]]["fingerprint"] == f"{p:016x}" and got[r["doc_id"]]["component_id"] == c


def test_groups_of_nulls_ties_and_repeats(spark):
    texts = [None, "", " \n", "Same words here now", "same WORDS here now", "other text altogether, quite another"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, "same words here now", "en", "s", 1), (3, texts[3], "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("component_id", F.lit("x"))
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(df).collect())
    assert got == Counter({(0, 0): 1, (1, 0): 1, (2, 0): 1, (3, 3): 2, (4, 3): 1, (5, 5): 1, (None, 3): 1})
    kept = simhash.first_of_groups(df).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 3, 5]
    alone = spark.createDataFrame([(None, "a b", None, None, None), (None, "a b", None, None, None)], DOCS)
    assert len(simhash.first_of_groups(alone).collect()) == 1
    assert simhash.simhash_groups(df.limit(0)).count() == 0


# quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {k for i, w in enumerate(windows) if often[w] > 1 for k in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def test_counts_equal_the_plain_ones():
    rng = random.Random(7)
    for _ in range(500):
        text = "".join(rng.choices(["a", "b", "é", " ", "\n", "\t", "#", "\x1c", "\xa0", "|"], k=rng.randrange(0, 60)))
        assert quality_rules.count_text(text)[:5] == plain_counts(text)
    assert quality_rules.count_text(None) == (0,) * 9


def test_op10_counts_and_base_rules(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_thresholds_follow_each_group_and_merge(spark):
    rng = random.Random(8)
    words = lambda n, k: " ".join("".join(rng.choices("abcdefgh", k=k)) for _ in range(n))
    rows = [(i, words(60, 5), "en", "short", 1) for i in range(150)] + [(i, words(60, 25), "en", "long", 1) for i in range(150, 300)]
    rows += [(900, words(60, 25), "en", "short", 1), (901, words(60, 5), "en", "long", 1), (902, None, None, None, None)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == 303 and all(got[i]["kept"] for i in range(300))
    assert not got[900]["kept"] and not got[901]["kept"] and got[902]["base_failed"]
    assert got[900]["failed_rules"] == ["word_length"]
    clash = quality_rules.quality_rules(spark.createDataFrame(rows[:3], DOCS).withColumn("kept", F.lit("x")))
    assert dict(clash.dtypes)["kept"] == "boolean" and clash.count() == 3
    assert quality_rules.quality_rules(clash.limit(0)).count() == 0


def test_every_fence_follows_the_sketches_of_its_group(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choices("abcdefgh", k=8))
    plain = lambda n=60: [word() for _ in range(n)]

    def signs(k):
        return " ".join(plain()[k:] + ["#"] * k)

    def lines(k):
        return "\n".join([" ".join(plain(6)) for _ in range(20 - k)] + [word()] * (k + 1))

    def capitals(k):
        return " ".join(w.upper() if i < k else w for i, w in enumerate(plain()))

    def again(k):
        w = plain(100)
        return " ".join(w + w[:k])

    make = {"symbols_per_word": (signs, 6, 20), "dup_line_share": (lines, 3, 7), "repeat_share": (again, 8, 20), "upper_share": (capitals, 6, 30)}
    rows, want = [], {}
    for m, (text, some, much) in make.items():
        for i in range(120):  # one group without any, another where a third of the documents has some
            rows += [(len(rows), text(0), "en", f"{m} none", 1), (len(rows) + 1, text(some * (i % 3 == 0)), "en", f"{m} some", 1)]
        for group, k, out in (("none", some, [m]), ("some", some, []), ("none", much, [m])):
            want[len(rows)] = out
            rows.append((len(rows), text(k), "en", f"{m} {group}", 1))
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    for i, out in want.items():
        assert [x for x in got[i]["failed_rules"] if x == rows[i][3].split()[0]] == out, (rows[i][3], got[i])
    assert all(got[i]["kept"] for i in got if i not in want)


def test_letters_are_counted_in_every_text():
    assert quality_rules.count_text("Ab cdé 12")[6:8] == (1, 5)


def test_sketch_quantiles_are_near_and_do_not_depend_on_partitions(spark):
    from quern.llm.sketches import merge, quantiles, sketch

    rng = random.Random(9)
    vals = [rng.expovariate(0.3) for _ in range(4000)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, m double")
    q = {"a": 0.25, "b": 0.5, "c": 0.95}
    whole = quantiles(merge(sketch(df.repartition(7), ["g"], ["m"]), []), [], q).first()
    again = quantiles(merge(sketch(df.repartition(2), ["g"], ["m"]), []), [], q).first()
    assert whole == again
    for k, p in q.items():
        want = sorted(vals)[int(p * len(vals)) - 1]
        assert abs(whole[k] - want) <= 0.02 * want
