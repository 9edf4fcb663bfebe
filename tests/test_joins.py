import random

import pytest
from pyspark.sql import functions as F

import billscope.operators.joins as Joins
from billscope.operators.address import address_pairs
from billscope.operators.dictionary import tag_matches
from billscope.operators.joins import add_presence, contains_pairs, distinct_join, exists_from_date, exists_in, not_exists_in, not_in


def values(df):
    return sorted((r[0] for r in df.collect()), key=str)


@pytest.fixture
def left(spark):
    return spark.createDataFrame([("a",), ("b",), (None,)], "k string")


@pytest.mark.parametrize(
    "listed, want",
    [(["a"], ["b"]), (["a", None], []), ([], ["a", "b", None]), ([None], []), (["z"], ["a", "b"])],
)
def test_not_in_follows_sql(spark, left, listed, want):
    other = spark.createDataFrame([(v,) for v in listed], "k string")
    assert values(not_in(left, other, "k")) == sorted(want, key=str)
    left.createOrReplaceTempView("t_left")
    other.createOrReplaceTempView("t_list")
    assert values(spark.sql("SELECT k FROM t_left WHERE k NOT IN (SELECT k FROM t_list)")) == sorted(want, key=str)


def test_not_exists_keeps_null_keys(spark, left):
    other = spark.createDataFrame([("a",), (None,)], "k string")
    assert values(not_exists_in(left, other, "k")) == sorted(["b", None], key=str)
    assert values(exists_in(left, other, "k")) == ["a"]


def test_presence_does_not_multiply(spark, left):
    other = spark.createDataFrame([("a",), ("a",)], "k string")
    assert sorted(map(tuple, add_presence(left, other, "k", "f").collect()), key=str) == sorted([("a", 1), ("b", 0), (None, 0)], key=str)


def test_distinct_join_equals_semi_join_with_distinct(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "k int, name string")
    other = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    want = df.join(other, "k").select("name").distinct()
    assert values(distinct_join(df, other, "k", ["name"])) == values(want) == ["x"]
    # without DISTINCT the two formulations differ when clients share a name
    assert exists_in(df, other, "k").count() == 2


def test_exists_from_date(spark):
    df = spark.createDataFrame([("a", "2020"), ("b", "2022"), ("c", None)], "k string, since string")
    other = spark.createDataFrame([("a", "2019", 1), ("a", "2021", 1), ("b", "2023", 0), ("c", "2020", 1)], "k string, paid string, ok int")
    assert values(exists_from_date(df, other, "k", "since", "paid", F.col("ok") > 0)) == ["a"]


def test_contains_pairs_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("аб в") for _ in range(n))
    needles = {word(rng.choice([1, 2, 3, 5, 9, 17, 40])) for _ in range(60)} | {""}
    hays = {word(rng.randrange(0, 70)) for _ in range(60)}
    hays |= {"x" + n + "y" for n in needles if len(n) > 8}
    got = contains_pairs(
        spark.createDataFrame([(n,) for n in needles] + [(None,)], "needle string"),
        spark.createDataFrame([(h,) for h in hays] + [(None,)], "haystack string"),
    )
    want = {(n, h) for n in needles for h in hays if n and n in h}
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert "CartesianProduct" not in plan(got) and "NestedLoop" not in plan(got)


def test_a_frequent_gram_is_no_key(spark, monkeypatch):
    """90 of 100 texts begin with one country; needles with it are looked up by what else they hold."""
    hays = [f"{'wonderland' if i % 10 else 'elsewhere'}, street {i:03d}" for i in range(400)]
    needles = [f"wonderland, street {i:03d}" for i in range(0, 400, 7)] + ["wonderland, avenue", "street 01"]
    met = []
    real = Joins.cut

    def seen(df, name="step"):
        out = real(df, name)
        met.append((name, out))
        return out

    monkeypatch.setattr(Joins, "cut", seen)
    frames_ = spark.createDataFrame([(n,) for n in needles], "needle string"), spark.createDataFrame([(h,) for h in hays], "haystack string")
    found = {tuple(r) for r in contains_pairs(*frames_).collect()}
    assert found == {(n, h) for n in needles for h in hays if n in h}
    wanted, held = (dict(met)[name] for name in ("grams", "held"))
    sizes = {r["_gram"]: r["n"] for r in held.groupBy("_gram").agg(F.count("*").alias("n")).collect()}
    rarest = {n: min(sizes.get(r["_gram"], 0) for r in wanted.where(F.col("needle") == n).collect()) for n in needles[:5] + needles[-2:]}
    assert sum(rarest.values()) <= 3 * sum(sum(n in h for h in hays) for n in rarest) and rarest["wonderland, avenue"] == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


ENTRY = {"full_address": "zzz", "city_text": "zzz", "district_text": "zzz"}
REGISTER = {"inn": "1", "house": None, "street": None, "district": None, "city": None, "region": None}
BRANCHES = [
    ({"house": "h7", "street": "mira", "district": "north"}, {"full_address": "mira street h7 north"}),
    ({"district": "north"}, {"city_text": "north town"}),
    ({"city": "omsk"}, {"city_text": "omsk"}),
    ({"city": "omsk"}, {"full_address": "omsk, lenina"}),
    ({"city": "omsk"}, {"district_text": "omskiy"}),
    ({"region": "ural"}, {"full_address": "ural, perm"}),
    ({"region": "ural"}, {"city_text": "uralsk"}),
]


def frames(spark, registers, entries):
    left = spark.createDataFrame(registers, "register long, inn string, house string, street string, district string, city string, region string")
    right = spark.createDataFrame(entries, "entry long, inn string, full_address string, city_text string, district_text string")
    return left, right


def brute(registers, entries):
    def within(needle, text):
        return needle is not None and text is not None and needle in text

    found = set()
    for r, inn, house, street, district, city, region in registers:
        for e, entry_inn, address, city_text, district_text in entries:
            same = inn is not None and inn == entry_inn  # NULL equals nothing
            exact = same and within(house, address) and within(street, address) and within(district, address)
            loose = (
                within(district, city_text)
                or within(city, city_text)
                or within(city, address)
                or within(city, district_text)
                or within(region, address)
                or within(region, city_text)
            )
            if exact or loose:
                found.add((r, e))
    return found


def test_each_address_rule_alone(spark):
    """Fourteen cases at once, kept apart by a letter in every word: each rule with and without the tax number."""
    registers, entries, want = [], [], set()
    for n, ((register, entry), same_inn) in enumerate((b, s) for b in BRANCHES for s in (True, False)):
        mark = chr(ord("а") + n)
        own = lambda fields: {k: v and " ".join(mark + w for w in v.split(" ")) for k, v in fields.items()}
        registers.append((n, *{**own({**REGISTER, **register}), "inn": f"i{n}"}.values()))
        entries.append((n, f"i{n}" if same_inn else "other", *own({**ENTRY, **entry}).values()))
        if same_inn or "house" not in register:
            want.add((n, n))
    assert {tuple(x) for x in address_pairs(*frames(spark, registers, entries)).collect()} == want == brute(registers, entries)


def test_address_pairs_equal_theta_join(spark):
    rng = random.Random(11)
    words = ["north", "omsk", "ural", "perm", "mira", "h7", "no", "om"]
    pick = lambda: rng.choice(words + [None] * 3)
    text = lambda: rng.choice([None, " ".join(rng.choices(words, k=3))])
    registers = [(i, rng.choice(["1", "2", None]), pick(), pick(), pick(), rng.choice(words[:3] + [None] * 9), None if i % 3 else pick()) for i in range(60)]
    entries = [(i, rng.choice(["1", "2", None]), text(), rng.choice(words + [None]), rng.choice(words + [None])) for i in range(60)]
    got = [tuple(x) for x in address_pairs(*frames(spark, registers, entries)).collect()]
    want = brute(registers, entries)
    assert len(got) == len(set(got)) and set(got) == want and want
    strict = {tuple(x) for x in address_pairs(*frames(spark, registers, entries), require_inn=True).collect()}
    inn_r, inn_e = {r[0]: r[1] for r in registers}, {e[0]: e[1] for e in entries}
    assert strict == {(r, e) for r, e in want if inn_r[r] is not None and inn_r[r] == inn_e[e]}


def test_tag_matches_equals_like(spark):
    import re

    tags = ["Red", "blue bolt", "b_r", "xy", "рек", "ab#c", "o%d", "%olo", "_ed", "%", "#", " red", "_", "%%x_z"]
    texts = ["red start", "the #RED", "colored", "a blue bolt", "bar", "see ber", "xyz", "реклама", " ab#c", "old", "an odd", "", None, "нет рек", "bluebolt"]
    like = lambda pattern: re.compile("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern), re.S)
    want = set()
    for i, text in enumerate(texts):
        for tag in {t.lower() for t in tags}:
            low = None if text is None else text.lower()
            if low is not None and any(like(p).fullmatch(low) for p in (f"%#{tag}%", f"% {tag}%", f"{tag}%")):
                want.add((i, tag))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = tag_matches(df, "id", "text", spark.createDataFrame([(t,) for t in tags + ["RED"]], "tags string"), "tags")
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want


def mentions(texts, tags):
    """Pairs of ``LIKE``, by brute force."""
    import re

    def like(pattern):
        return re.compile("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern), re.S)

    found = [(t, [like(p) for p in (f"%#{t}%", f"% {t}%", f"{t}%")]) for t in {t.lower() for t in tags}]
    return {(i, t) for i, text in enumerate(texts) if text is not None for t, ps in found if any(p.fullmatch(text.lower()) for p in ps)}


def test_tag_matches_of_all_kinds(spark):
    import random

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(0, 5)))
    texts = ["".join(word() + rng.choice([" ", " ", "#", "  ", "_", "%", "\n"]) for _ in range(rng.randint(0, 9))) for _ in range(60)] + ["a" * 40 + "b", "x" + "ab" * 20]
    tags = {word() for _ in range(40)} | {"%" + word() for _ in range(15)} | {word() + "%" + word() for _ in range(15)} | {f"%{word()}%" for _ in range(15)}
    tags |= {word() + " " + word() for _ in range(15)} | {word() + "#" + word() for _ in range(8)} | {word() + "_" + word() for _ in range(8)}
    tags |= {"a" * 33, "a" * 41, "%" + "ab" * 18, "%ab%" + "a" * 33, "a" * 20 + "%b", "a%", "a%%", "%%", " ", "# ", ""}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for some in (tags, {" ", "# "}, {"%%", "_"}, {"a b"}, {"%ab"}):
        got = tag_matches(df, "id", "text", spark.createDataFrame([(t,) for t in some], "tags string"), "tags")
        found = [tuple(r) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == mentions(texts, some)


def test_tag_matches_keys_met_twice_count_once(spark):
    texts = spark.createDataFrame([(1, "red bolt"), (1, "reddish #bolt"), (None, "red"), (None, "a redo"), (2, None)], "id int, text string")
    got = tag_matches(texts, "id", "text", spark.createDataFrame([("red",), ("%olt",)], "tags string"), "tags")
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "%olt"), (1, "red"), (None, "red")]


def test_tag_matches_moves_no_words(spark):
    """Texts are written as they are, not word by word."""
    import glob

    from billscope.session import RunTables

    many = spark.range(300).selectExpr("cast(id as int) id", "array_join(transform(sequence(1, 200), i -> concat('w', (id * 7 + i * 13) % 900)), ' ') text")
    with RunTables(spark) as run:
        got = tag_matches(many, "id", "text", spark.createDataFrame([("w1",), ("w22",)], "tags string"), "tags")
        pairs = got.count()
        rows = [spark.read.parquet(path).count() for path in glob.glob(f"{run.path.removeprefix('file:')}/*/*")]
        assert rows and max(rows) <= max(300, pairs)
        assert pairs == many.selectExpr("id", "explode(split(text, ' ')) w").selectExpr("id", "explode(array('w1', 'w22')) t", "w").where("startswith(w, t)").select("id", "t").distinct().count()
