"""Document fingerprints from closed syncmers, with Spark functions only.

The alphabet is words; a word of more than ``LONG`` characters (unspaced
writing) counts as its characters.  A run of ``K`` symbols is chosen if the
smallest hash among its inner runs of ``S`` symbols is the first or the last
one: the choice looks at the run alone, so equal passages choose equal anchors
wherever they stand.  A text whose words choose no anchor (four or fewer)
is read as its characters.  A fingerprint is all anchors of a text in order of
place, repeated ones too: 16 hex digits of the hash, ``@`` and the number of
symbols before it, with blanks between.  The likeness of two texts is the share
of common hashes among all different ones of both (places do not count); if the
words of one of them choose no anchor, both are read as characters for it.

The next document by ascending doc_id comes from windows over stretches of
ids of bounded length and the first ids of the stretches, not from one global
sort.

Defined cases: a null text is empty, and an empty text has an empty
fingerprint, like no other; texts whose characters choose no anchor either have
one, of the whole text; rows that share a doc_id follow one another nowhere: the
next of each is the next larger id, whose smallest text stands for it; a row
without id has no next document (empty text); extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspan.operators.ranks import cut_points, part_of

K, S = 4, 2
# characters of the longest word that is one symbol
LONG = 32
# ids in one window, on average (more where that made over 512 windows)
STRETCH = 4096


def let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and names it in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def chosen_sql(symbols: str) -> str:
    """(hash, place) of the anchors of an array of symbols, by place."""
    inner = ", ".join(f"h[i + {j}]" for j in range(S))
    small = f"if(size(h) < {K}, array(), transform(sequence(0, size(h) - {S}), i -> xxhash64({inner})))"
    last = K - S
    middle = ", ".join(f"m[i + {j}]" for j in range(1, last))
    middle = f"least({middle})" if last > 2 else middle
    # the two outer runs cover the whole run of K symbols
    chosen = (f"if(size(m) = 0, array(), filter(transform(sequence(0, size(m) - {last + 1}), "
              f"i -> if(least(m[i], m[i + {last}]) <= {middle}, "
              f"named_struct('hash', xxhash64(m[i], m[i + {last}]), 'place', i), null)), x -> x is not null))")
    return let(f"transform({symbols}, x -> xxhash64(x))", "h", let(small, "m", chosen))


def anchors_sql(text: str) -> str:
    """The anchors that the words of a text choose."""
    words = f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')"
    return let(words, "w", chosen_sql(
        f"if(exists(w, x -> length(x) > {LONG}), "
        f"flatten(transform(w, x -> if(length(x) > {LONG}, split(x, ''), array(x)))), w)"))


def characters_sql(text: str) -> str:
    """The anchors that the characters of a text choose, or its own hash."""
    whole = f"if({text} = '', array(), array(named_struct('hash', xxhash64({text}), 'place', 0)))"
    return let(chosen_sql(f"split({text}, '')"), "c", f"if(size(c) = 0, {whole}, c)")


def likeness_sql(a: str, text_a: str, b: str, text_b: str) -> str:
    """Of the anchors ``a`` and ``b`` that the words of two texts choose."""
    def share(a: str, b: str) -> str:
        return let(f"size(array_intersect({a}.hash, {b}.hash))", "n",
                   f"n / cast(size(array_distinct({a}.hash)) + size(array_distinct({b}.hash)) - n as double)")
    return (f"case when {text_a} = '' or {text_b} = '' then if({text_a} = {text_b}, 1.0D, 0.0D) "
            f"when size({a}) > 0 and size({b}) > 0 then {share(a, b)} else "
            + let(characters_sql(text_a), "ca", let(characters_sql(text_b), "cb", share("ca", "cb"))) + " end")


def print_sql(a: str, text: str) -> str:
    return let(f"if(size({a}) > 0, {a}, {characters_sql(text)})", "p",
               "array_join(transform(p, x -> concat(lpad(hex(x.hash), 16, '0'), '@', x.place)), ' ')")


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next larger id, after the largest the smallest.

    ``ids`` holds each id once.  They are cut into stretches at sampled points
    of their own, so far ids and crowds of them alike make stretches of about
    the same size, and each stretch is one window.
    """
    ids = ids.select("doc_id", F.lit(0).alias("g"))
    cuts = cut_points(ids.withColumnRenamed("doc_id", "p"), ["g"], STRETCH).drop("parts")
    ids = ids.join(cuts, "g", "left").select("doc_id", part_of("doc_id", "cuts_p").alias("stretch"))
    # a row for each stretch
    firsts = ids.groupBy("stretch").agg(F.min("doc_id").alias("first"))
    every = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = firsts.select("stretch", F.coalesce(F.lead("first").over(Window.orderBy("stretch")), F.min("first").over(every)).alias("after"))
    own = F.lead("doc_id").over(Window.partitionBy("stretch").orderBy("doc_id"))
    return ids.withColumn("own", own).join(follow, "stretch") \
        .select("doc_id", F.coalesce("own", "after").alias("next_id"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next for every row."""
    ids = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    base = docs.select(ids, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    asked = base.where("doc_id is not null").select("doc_id").distinct()
    asked = asked.join(next_ids(asked.select("doc_id")), "doc_id") \
        .select(F.col("doc_id").alias("asker"), F.col("next_id").alias("doc_id"))
    # both joins read one shuffle of texts by id; anchors are made after it
    # (texts take less room than all of their anchors)
    known = base.where("doc_id is not null")
    heads = known.join(asked, "doc_id").groupBy("asker").agg(F.min("text").alias("after"))
    paired = known.join(heads, known.doc_id == heads.asker).select("doc_id", "text", "after")
    unnamed = base.where("doc_id is null").select("doc_id", "text", F.lit("").alias("after"))
    out = paired.unionByName(unnamed) \
        .withColumn("n_chars", F.length("text").cast("long")) \
        .withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 4 as int)), "
                                     "substring(after, 1, cast(n_chars div 4 as int)))")) \
        .withColumn("own", F.expr(anchors_sql("text"))) \
        .withColumn("theirs", F.expr(anchors_sql("edited"))) \
        .withColumn("next", F.expr(anchors_sql("after")))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      F.expr(print_sql("own", "text")).alias("fingerprint"),
                      F.expr(print_sql("theirs", "edited")).alias("edited_fingerprint"),
                      F.expr(likeness_sql("own", "text", "theirs", "edited")).alias("near_edited"),
                      F.expr(likeness_sql("own", "text", "next", "after")).alias("near_next"))
