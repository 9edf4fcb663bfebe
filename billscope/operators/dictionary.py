"""Tags of a dictionary found in free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.session import cut, spread

SIZES = (1, 2, 4, 8, 16, 32)
# What stands between words.
BREAKS = " #"


def _regex(tag: Column) -> Column:
    """A tag with wildcards as one regular expression for all three places a mention may stand at, in a text after a blank."""
    quoted = F.regexp_replace(tag, r"([.\[\]{}()*+?^$|&~-])", r"\\$1")
    inner = F.regexp_replace(F.regexp_replace(quoted, "%+$", ""), "%+", ".*?")
    return F.concat(F.lit("(?s)[ #]"), F.replace(inner, F.lit("_"), F.lit(".")))


def _mentions(text: Column, tag: Column, regex: Column) -> Column:
    """``tag`` right after a #, right after a blank, or at the start of ``text``; % and _ in tags stay wildcards."""
    literal = F.contains(text, F.concat(F.lit("#"), tag)) | F.contains(text, F.concat(F.lit(" "), tag)) | F.startswith(text, tag)
    pattern = (
        F.like(text, F.concat(F.lit("%#"), tag, F.lit("%")))
        | F.like(text, F.concat(F.lit("% "), tag, F.lit("%")))
        | F.like(text, F.concat(tag, F.lit("%")))
    )
    escaped, wild = F.instr(tag, "\\") > 0, F.instr(tag, "%") + F.instr(tag, "_") > 0
    return F.when(escaped, pattern).when(wild, F.rlike(F.concat(F.lit(" "), text), regex)).otherwise(literal)


def _looked_up(tags: DataFrame) -> DataFrame:
    """``tags``, numbered, with what a text must hold to mention them: ``gram``, at the start of a word or ``inside`` one; ``decided``: that is
    enough.

    A tag of one word is looked up by all of it, any other by its first literal word: by the longest of a few prefix lengths of
    that, or by the ``whole`` word and a blank where a blank or # follows. Of a tag that opens with a wildcard the first literal run
    lies somewhere inside a word. A tag without any literal word needs its blanks and #, which stand for words here, or nothing,
    which the empty word stands for.
    """
    word = r"[^ #%_\\]+"
    tags = tags.select(
        "tag",
        F.regexp_extract("tag", rf"({word})", 1).alias("_word"),
        F.regexp_like("tag", F.lit(rf"^%*{word}%*$")).alias("decided"),
        F.regexp_like("tag", F.lit(rf"^[ #]*{word}[ #]")).alias("whole"),
        (~F.regexp_like("tag", F.lit(rf"^[ #]*{word}")) & F.regexp_like("tag", F.lit(word))).alias("inside"),
    )
    wordless = F.when(F.contains("tag", F.lit("#")), "#").when(F.contains("tag", F.lit(" ")), " ").otherwise("")
    size = F.lit(SIZES[0])
    for n in SIZES[1:]:
        size = F.when(F.length("_word") >= n, n).otherwise(size)
    gram = F.when(F.col("_word") == "", wordless).when(F.col("decided"), F.col("_word"))
    gram = gram.when(F.col("whole"), F.concat("_word", F.lit(" "))).otherwise(F.left(F.col("_word"), size))
    regex = F.when(~F.col("decided"), _regex(F.col("tag")))
    return tags.select(F.monotonically_increasing_id().alias("number"), "tag", gram.alias("gram"), "inside", "decided", "whole", regex.alias("regex"))


def _words(texts: DataFrame, key: str, closed: bool) -> DataFrame:
    """``key``, ``word``, ``_at``, ``_long`` and ``_before``: the words of each text once, in order, each with its place from 0, its length
    and the one before it. The empty word and what stands between the words are among them; ``closed`` words end in a blank.
    """
    breaks = [F.when(F.contains("_low", F.lit(b)), b).otherwise("") for b in BREAKS]
    words = F.concat(F.split(F.replace("_low", F.lit("#"), F.lit(" ")), " "), F.array(F.lit(""), *breaks))
    words = F.sort_array(F.array_distinct(F.transform(words, lambda w: F.concat(w, F.lit(" "))) if closed else words))
    # outer, or Spark asks for the size of the array first and makes it twice
    placed = texts.select(key, words.alias("words")).select(key, "words", F.posexplode_outer("words").alias("_at", "word"))
    return placed.select(key, "word", "_at", F.length("word").alias("_long"), F.coalesce(F.get("words", F.col("_at") - 1), F.lit("")).alias("_before"))


def _sizes(tags: DataFrame) -> tuple[list[int], Column]:
    """The lengths of the tags' grams, a few numbers, and one row for each."""
    sizes = sorted(tags.agg(F.collect_set(F.length("gram"))).first()[0])
    return sizes, F.explode_outer(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("_size")


def _met(offered: DataFrame, tags: DataFrame) -> DataFrame:
    """Grams meet those of tags by a hash, which is several times as fast as by texts, and are compared then."""
    both = offered.withColumn("_hash", F.xxhash64("_gram")).join(tags.withColumn("_hash", F.xxhash64("gram")), "_hash")
    return both.where(F.startswith("_gram", "gram") & F.startswith("gram", "_gram")).drop("_hash", "_gram")


def _held(texts: DataFrame, key: str, tags: DataFrame) -> DataFrame:
    """``key`` and the columns of ``tags`` where a word of the text starts with the tag's gram; a row of ``texts`` gives a tag once."""
    closed = bool(tags.agg(F.max("whole")).first()[0])
    start = F.left(F.col("word"), F.col("_size"))
    starts = _words(texts, key, closed).select("*", _sizes(tags)[1]).where("_long >= _size")
    # words are in order, so a start that the word before has not is new
    starts = starts.where((F.col("_at") == 0) | ~F.startswith("_before", start))
    return _met(starts.select(key, start.alias("_gram")), tags)


def _held_inside(texts: DataFrame, key: str, tags: DataFrame) -> DataFrame:
    """``key`` and the columns of ``tags`` where a word of the text holds the tag's gram anywhere, once."""
    sizes, size = _sizes(tags)
    least = min(sizes, default=1)
    words = _words(texts, key, False).select(key, "word", "_long").where(F.col("_long") >= least)
    places = words.select("*", F.explode_outer(F.sequence(F.lit(1), F.col("_long") - least + 1)).alias("_place"))
    windows = places.select("*", size).where("_place + _size - 1 <= _long")
    found = _met(windows.select(key, F.expr("substring(word, _place, _size)").alias("_gram")), tags.select("number", "gram"))
    return found.select(key, "number").distinct().join(tags, "number")


def tag_matches(texts: DataFrame, key: str, text: str, dictionary: DataFrame, tag: str) -> DataFrame:
    """(``key``, ``tag``) for every lower-cased dictionary tag the text mentions; ``key`` is unique.

    The words of each text are put in order where they lie and cut to the lengths that tags are looked up by; each start of a word
    meets the tags once, in an equi join of any size, so these pairs are distinct without an exchange. A tag of one word is decided
    by the words alone, so no text is looked at for it. The candidates among the others are collected per text and checked in one
    pass over one copy of it. Tags, lower-cased texts and what their words start with are written once.
    """
    tags = cut(_looked_up(dictionary.select(F.lower(tag).alias("tag")).where(F.col("tag").isNotNull()).distinct()), "tags")
    low = cut(spread(texts.select(key, text)).select(key, F.lower(text).alias("_low")).where(F.col("_low").isNotNull()), "texts")
    # texts with one key count as one
    again = cut(low.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n")).where("n > 1").select("_key"), "again")
    one, more = (low.join(again, low[key].eqNullSafe(again["_key"]), how) for how in ("left_anti", "left_semi"))
    starts, inside = (tags.where(which).select("number", "tag", "gram", "whole", "decided", "regex") for which in ("not inside", "inside"))
    held = _held(one, key, starts).unionByName(_held(more, key, starts).distinct())
    held = cut(held.select(key, "tag", "regex", "decided"), "starts")
    found = held.where("decided").select(key, "tag").unionByName(_held_inside(low, key, inside.where("decided")).select(key, "tag"))
    asked = held.where("not decided").unionByName(_held_inside(low, key, inside.where("not decided")).select(*held.columns))
    asked = asked.groupBy(key).agg(F.collect_set(F.struct("tag", "regex")).alias("_tags"))
    checked = low.join(asked, key).select(key, "_low", F.explode("_tags").alias("_tag"))
    checked = checked.where(_mentions(F.col("_low"), F.col("_tag.tag"), F.col("_tag.regex"))).select(key, F.col("_tag.tag").alias("tag"))
    return found.unionByName(checked)
