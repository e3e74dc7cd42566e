"""Entity resolution: best match against seeds, batch deduplication, mapping log.

Every pair that can be accepted shares a key (``functions.fuzzy``), so pairs come from an equi-join on keys,
never from a cross join. These keep hot keys from blowing up:

* names are reduced to their distinct forms before anything is compared;
* names that share a key are compared in cells on counts of letters (``operators.cells``), and what that leaves is scored once;
* a shared token alone links names whose lengths differ enough, however many carry it; those links are never
  listed but summarised per (token, length) by their earliest position;
* the batch is taken in slices of doubling size, and each slice meets the representatives found so far before its
  own pairs are formed, so a crowd of near copies leaves with its first member.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions import fuzzy
from tidemill.operators.cells import matched, pairs_in_cells, settled
from tidemill.operators.edits import LONGEST
from tidemill.session import BROADCAST_ROWS, cut, is_small

#: A key with more rows than this is split into parts of this size.
HOT_ROWS = 100_000
#: References compared by edits go to every task up to this many, as a trie.
EDIT_ROWS = 100_000
#: What is left of a slice is settled by one task up to this many names, in parallel rounds beyond.
SETTLE_ROWS = 2_048
#: Names of a larger rest that one task settles before the others meet what leads there.
TURN_ROWS = 8_192
_UNDECIDED, _LEADER, _FOLLOWER = 0, 1, 2


# --- pairs ------------------------------------------------------------------------------------------


def _accepted(score: Column, threshold: int) -> Column:
    return F.bround(score, 0) >= threshold


def _token_is_enough(scorer: str, threshold: int) -> bool:
    """Whether one shared token is enough for a link."""
    return scorer == "wratio" and round(fuzzy.TOKEN_SCORE) >= threshold


def _prepared(forms: DataFrame, prefix: str = "") -> DataFrame:
    """Forms with their sorted words, the words as a set and the sorted text: what every pair test needs, once per name."""
    words = F.array_sort(F.split("form", " +"))
    return forms.select("pos", "form", words.alias("words")).select(
        F.col("pos").alias(f"{prefix}pos"), F.col("form").alias(f"{prefix}form"),
        F.array_distinct("words").alias(f"{prefix}words"), F.array_join("words", " ").alias(f"{prefix}sorted"),
    )


def _linked_by_token() -> Column:
    """One shared token between forms whose lengths differ by a factor of 1.5 to 8."""
    short, long = (f(F.length("form"), F.length("ref_form")) for f in (F.least, F.greatest))
    return (long >= short * 1.5) & (long <= short * 8) & F.arrays_overlap("words", "ref_words")


def _scored(pairs: DataFrame, scorer: str) -> DataFrame:
    if scorer == "levenshtein":
        return pairs.withColumn("score", fuzzy.levenshtein_score(F.col("form"), F.col("ref_form")))
    score = fuzzy.SCORERS[scorer]

    @F.pandas_udf("double")
    def scores(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([score(x, y) for x, y in zip(a, b)], dtype="float64")

    return pairs.withColumn("score", scores("form", "ref_form"))


def _may_match(threshold: int, scorer: str) -> Column:
    """A native test on prepared forms that every accepted pair passes, so that the join drops most other pairs itself.

    Levenshtein distance never exceeds the count of insertions and deletions the ratios are made of, so each ratio above
    its bound gives a bound on the distance.
    """
    a, b = F.col("form"), F.col("ref_form")
    if scorer == "levenshtein":
        return fuzzy.levenshtein_score(a, b) >= threshold
    bound = threshold - 0.5

    def near(x: Column, y: Column, loss: float, extra: Column | float = 0) -> Column:
        return F.levenshtein(x, y) <= (F.length(x) + F.length(y) + extra) * loss + 1e-6

    def window(x: Column, y: Column) -> Column:
        short, long = F.least(F.length(x), F.length(y)), F.greatest(F.length(x), F.length(y))
        # Outside the window everything is lost, inside it little; a window cut off at an end is counted twice.
        return F.levenshtein(x, y) <= long - short + short * (4 * (1 - bound / 90)) + 1e-6

    if scorer == "ratio":
        return near(a, b, 1 - bound / 100)
    sorted_a, sorted_b, set_a, set_b = (F.col(c) for c in ("sorted", "ref_sorted", "words", "ref_words"))
    join = lambda words: F.array_join(words, " ")
    common = F.array_intersect(set_a, set_b)
    only_a, only_b = join(F.array_except(set_a, common)), join(F.array_except(set_b, common))
    shared, gap = F.length(join(common)), F.least(F.size(common), F.lit(1))
    loss = 1 - bound / 95
    rest = F.least(F.length(only_a), F.length(only_b))
    by_set = (shared > 0) & ((rest == 0) | (rest + 1 <= (shared * 2 + rest + 1) * loss + 1e-6))
    alike = near(a, b, 1 - bound / 100) | by_set | near(sorted_a, sorted_b, loss) | near(only_a, only_b, loss, (shared + gap) * 2)
    inside = window(a, b) | window(sorted_a, sorted_b) | window(join(set_a), join(set_b))
    similar_length = F.greatest(F.length(a), F.length(b)) < F.least(F.length(a), F.length(b)) * 1.5
    return F.when(similar_length, alike).otherwise(inside)


def _salted(keyed: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the rows of hot keys into salts and repeat their references once per salt.

    Counts combine before the shuffle, and at most one key in ``HOT_ROWS`` rows is hot, so that list is short.
    """
    hot = keyed.groupBy("key").count().filter(F.col("count") > HOT_ROWS)
    salts = hot.select(F.col("key").alias("_hot"), F.ceil(F.col("count") / HOT_ROWS).cast("int").alias("_salts"))
    n = F.coalesce("_salts", F.lit(1))
    left = keyed.join(salts, F.col("key") == F.col("_hot"), "left").withColumn("salt", F.pmod(F.xxhash64("pos"), n).cast("int"))
    right = refs.join(salts, F.col("ref_key") == F.col("_hot"), "left").withColumn("ref_salt", F.explode(F.sequence(F.lit(0), n - 1)))
    return left.drop("_hot", "_salts"), right.drop("_hot", "_salts")


def _keyed_pairs(left: DataFrame, refs: DataFrame, threshold: int, scorer: str, earlier_only: bool = False) -> DataFrame:
    """All accepted pairs ``pos, ref_pos, score`` that share a key and are not linked by a token anyway.

    Forms that share a trigram meet in cells; under the weighted ratio those that share most of their words meet on their rarest ones too. A
    pair is scored once, however many keys it shares, and only if its letters allow the threshold.
    """
    by_tokens = _token_is_enough(scorer, threshold)
    a, b = left.select("form").distinct(), refs.select("form").distinct()

    def keyed(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
        return df.select("form", F.explode(key).alias(name))

    met, refs_met = _salted(keyed(a, fuzzy.keys(F.col("form"))).withColumn("pos", F.col("form")), keyed(b, fuzzy.keys(F.col("form")), "ref_key"))
    refs_met = refs_met.select(F.col("ref_key").alias("key"), F.col("ref_salt").alias("salt"), "form")
    pairs = pairs_in_cells(met, refs_met, threshold, scorer, earlier_only, by_tokens)
    short, long = (f(F.length("form"), F.length("ref_form")) for f in (F.least, F.greatest))
    if scorer == "wratio":
        prepared_a, prepared_b = _prepared(a.withColumn("pos", F.lit(0))).drop("pos"), _prepared(b.withColumn("pos", F.lit(0)), "ref_").drop("ref_pos")
        wanted = long <= short * 8
        if by_tokens:
            wanted = wanted & ~_linked_by_token()
        if earlier_only:
            wanted = wanted & (F.col("form") < F.col("ref_form"))

        def meet(x: DataFrame, y: DataFrame, test: Column) -> DataFrame:
            return x.join(y, (F.col("key") == F.col("ref_key")) & test).select("form", "ref_form")

        counts = cut(b.select(F.explode(fuzzy.tokens(F.col("form"))).alias("key")).groupBy("key").agg(F.count("*").alias("n")))
        rare_a, rare_b = _rare_tokens(a, counts, threshold), _rare_tokens(b, counts, threshold)
        tokens_a = prepared_a.select("*", F.explode(fuzzy.tokens(F.col("form"))).alias("key"))
        tokens_b = prepared_b.select("*", F.explode(fuzzy.tokens(F.col("ref_form"))).alias("ref_key"))
        similar = wanted & (long < short * 1.5) & _alike_by_words(threshold)
        more = [
            meet(prepared_a.join(rare_a, "form"), tokens_b, similar),
            meet(tokens_a, prepared_b.join(rare_b.toDF("ref_form", "ref_key"), "ref_form"), similar),
        ]
        # One token of at most two characters need not share a trigram with what it lies in.
        tiny_a, tiny_b = (_keys_of(x, name, k) for x, name, k in ((prepared_a, "form", "key"), (prepared_b, "ref_form", "ref_key")))
        more += [meet(tiny_a[0], tiny_b[1], wanted), meet(tiny_a[1], tiny_b[0], wanted)]
        pairs = reduce(DataFrame.unionByName, more, pairs).distinct()
    # Once per pair now: what Spark itself can rule out needs no score.
    pairs = _pair_words(pairs).filter(_may_match(threshold, scorer)).select("form", "ref_form")
    accepted = _scored(pairs, scorer).filter(_accepted(F.col("score"), threshold))
    at, ref_at = left.select("form", "pos"), refs.select(F.col("form").alias("ref_form"), F.col("pos").alias("ref_pos"))
    if not earlier_only:
        return accepted.join(at, "form").join(ref_at, "ref_form").select("pos", "ref_pos", "score")
    both = accepted.join(at, "form").join(ref_at, "ref_form")
    return both.select(F.greatest("pos", "ref_pos").alias("pos"), F.least("pos", "ref_pos").alias("ref_pos"), "score")


def _pair_words(pairs: DataFrame) -> DataFrame:
    """``form, ref_form`` with what ``_prepared`` gives of each."""
    both = pairs.withColumns({c: F.array_sort(F.split(f, " +")) for c, f in (("words", "form"), ("ref_words", "ref_form"))})
    joined = both.withColumns({"sorted": F.array_join("words", " "), "ref_sorted": F.array_join("ref_words", " ")})
    return joined.withColumns({"words": F.array_distinct("words"), "ref_words": F.array_distinct("ref_words")})


def _keys_of(prepared: DataFrame, form: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Forms by what short tokens they are made of, and by the short runs they hold."""
    return tuple(prepared.select("*", F.explode(f(F.col(form))).alias(key)) for f in (fuzzy.short_keys, fuzzy.inner_keys))


def _rare_tokens(forms: DataFrame, counts: DataFrame, threshold: int) -> DataFrame:
    """``form, key``: of each form's tokens the rarest, so many that one of them is shared if most of the form's words are.

    A form is accepted for its words in common when what is left of it is at most this share of those; more than that share of its letters
    cannot be left out.
    """
    loss = max(0.0, 1 - (threshold - 0.5) / 95)
    left = 2 * (2 * loss / (1 - loss))  # for each letter in common, spaces between one-letter words counted too
    share = left / (1 + left)
    listed = forms.select("form", F.explode(fuzzy.tokens(F.col("form"))).alias("key")).join(counts, "key", "left").filter("n > 0")
    every = listed.groupBy("form").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
    # Tokens that nobody else has are not offered, but count as left out.
    letters = lambda k: F.length(k["key"])
    total = F.aggregate(fuzzy.tokens(F.col("form")), F.lit(0), lambda s, t: s + F.length(t))
    known = F.aggregate("keys", F.lit(0), lambda s, k: s + letters(k))
    taken = F.aggregate(
        "keys", F.struct((total - known).alias("out"), F.array().cast("array<string>").alias("offered")),
        lambda s, k: F.when(
            s["out"] <= total * share + 1e-6,
            F.struct((s["out"] + letters(k)).alias("out"), F.concat(s["offered"], F.array(k["key"])).alias("offered")),
        ).otherwise(s),
    )
    return every.select("form", F.explode(taken["offered"]).alias("key"))


def _alike_by_words(threshold: int) -> Column:
    """Whether the words in common are enough of one of two prepared forms."""
    common = F.array_intersect("words", "ref_words")
    only_a, only_b = (F.length(F.array_join(F.array_except(c, common), " ")) for c in ("words", "ref_words"))
    shared, rest, loss = F.length(F.array_join(common, " ")), F.least(only_a, only_b), 1 - (threshold - 0.5) / 95
    return (shared > 0) & ((rest == 0) | (rest + 1 <= (shared * 2 + rest + 1) * loss + 1e-6))


# --- token links -------------------------------------------------------------------------------------


def _token_rows(forms: DataFrame) -> DataFrame:
    return forms.select("pos", F.length("form").alias("len"), F.explode(fuzzy.tokens(F.col("form"))).alias("token"))


def _token_links(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """For every name the earliest leader and the earliest undecided name that one of its tokens links it to.

    ``refs`` carries ``pos, len, token, status``. It is reduced to one row per token that holds the earliest
    position for each length and status, so lengths, not names, bound its size.
    """
    summary = (
        refs.groupBy("token", "len", "status")
        .agg(F.min("pos").alias("first"))
        .groupBy("token")
        .agg(F.collect_list(F.struct("len", "status", "first")).alias("seen"))
    )

    def earliest(status: int) -> Column:
        def linked(x: Column) -> Column:
            short, long = F.least("len", x["len"]), F.greatest("len", x["len"])
            return (x["status"] == status) & (long >= short * 1.5) & (long <= short * 8)

        return F.array_min(F.transform(F.filter("seen", linked), lambda x: x["first"]))

    return rows.join(summary, "token").select(
        "pos", earliest(_LEADER).alias("leader"), earliest(_UNDECIDED).alias("waiting")
    )


def _earliest_by_token(forms: DataFrame, refs: DataFrame) -> DataFrame:
    """``pos, ref_pos`` of the earliest reference linked by a token."""
    links = _token_links(_token_rows(forms), _token_rows(refs).withColumn("status", F.lit(_LEADER)))
    return links.filter(F.col("leader").isNotNull()).groupBy("pos").agg(F.min("leader").alias("ref_pos"))


# --- matching against references ---------------------------------------------------------------------


def _few(refs: DataFrame, scorer: str) -> list[tuple] | None:
    """The references as ``(pos, form)`` if there are so few that every task may have them; else None."""
    most = EDIT_ROWS if scorer == "levenshtein" else BROADCAST_ROWS
    rows = refs.select("pos", "form").limit(most + 1).collect()
    return [tuple(r) for r in rows if r.form] if len(rows) <= most else None


def _among_few(forms: DataFrame, few: list[tuple], scorer: str) -> tuple[DataFrame, DataFrame | None]:
    """The forms that tasks match against a list of references, and those they had better not: too long for the trie, and the list too long for anything else."""
    if len(few) <= BROADCAST_ROWS:
        return _spread(forms), None
    fits = F.length("form") <= LONGEST
    return _spread(forms.filter(fits)), forms.filter(~fits)


def _spread(forms: DataFrame) -> DataFrame:
    """The forms dealt to all tasks: a score costs far more than moving a name."""
    return forms.repartition(int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _best_match(forms: DataFrame, refs: DataFrame, threshold: int, scorer: str) -> DataFrame:
    """``pos, ref_pos, score`` of the best reference per form; ties go to the earliest reference."""
    few = _few(refs, scorer)
    if few is not None:
        short, forms = _among_few(forms, few, scorer)
        found = matched(short, few, threshold, scorer, first=False)
        if forms is None:
            return found
    pairs = _keyed_pairs(forms, refs, threshold, scorer)
    if _token_is_enough(scorer, threshold):
        by_token = _earliest_by_token(forms, refs).withColumn("score", F.lit(fuzzy.TOKEN_SCORE))
        pairs = pairs.unionByName(by_token).unionByName(_lifted_pairs(forms, refs))
    best = pairs.groupBy("pos").agg(
        F.max_by("ref_pos", F.struct("score", -F.col("ref_pos"))).alias("ref_pos"), F.max("score").alias("score")
    )
    return best if few is None else found.unionByName(best)


def _lifted_pairs(forms: DataFrame, refs: DataFrame) -> DataFrame:
    """Token-linked pairs whose best window may lift the score above the token score.

    That takes a window ratio above 95. Up to ten characters the shorter form then lies in the longer one as it is;
    beyond that they share a run of five characters.
    """

    def runs(text: Column, size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - size + 1)
        found = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
        return F.when(F.length(text) >= size, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))

    def offered(text: Column) -> Column:
        return F.concat(*[runs(text, size) for size in range(1, 6)])

    def asked(text: Column) -> Column:
        return F.when(F.length(text) <= 10, F.array(F.substring(text, 1, 5))).otherwise(runs(text, 5))

    def keyed(df: DataFrame, key: Column, prefix: str = "") -> DataFrame:
        return _prepared(df, prefix).select("*", F.explode(key).alias(f"{prefix}key"))

    form = F.col("form")
    ref_form = F.col("ref_form")
    met = [
        (keyed(forms, asked(form)), keyed(refs, offered(ref_form), "ref_"), F.length(form) < F.length(ref_form)),
        (keyed(forms, offered(form)), keyed(refs, asked(ref_form), "ref_"), F.length(form) > F.length(ref_form)),
    ]
    linked = _linked_by_token()
    pairs = [
        a.join(b, (F.col("key") == F.col("ref_key")) & order & linked).select("pos", "form", "ref_pos", "ref_form")
        for a, b, order in met
    ]
    return _scored(pairs[0].unionByName(pairs[1]).distinct(), "wratio").select("pos", "ref_pos", "score")


def _first_match(forms: DataFrame, refs: DataFrame, threshold: int, scorer: str) -> DataFrame:
    """``pos, ref_pos`` of the earliest accepted reference per form."""
    few = _few(refs, scorer)
    if few is not None:
        short, forms = _among_few(forms, few, scorer)
        found = matched(short, few, threshold, scorer, first=True).select("pos", "ref_pos")
        if forms is None:
            return found
    pairs = _keyed_pairs(forms, refs, threshold, scorer).select("pos", "ref_pos")
    if _token_is_enough(scorer, threshold):
        pairs = pairs.unionByName(_earliest_by_token(forms, refs))
    earliest = pairs.groupBy("pos").agg(F.min("ref_pos").alias("ref_pos"))
    return earliest if few is None else found.unionByName(earliest)


def canonicalize(
    names: DataFrame, seeds: DataFrame, name: str = "name", threshold: int = 85, scorer: str = "wratio", clean: bool = True
) -> DataFrame:
    """Adds ``canonical_name`` and ``match_score``: the best seed at or above the threshold, else the name and 0.

    ``seeds`` holds ``seed_pos, seed``; equal scores go to the lowest position. ``scorer`` is ``wratio``, ``ratio``
    or ``levenshtein``; thresholds below ``fuzzy.MIN_THRESHOLD`` are refused, whatever the sizes.
    """
    if threshold < fuzzy.MIN_THRESHOLD:
        raise ValueError(f"threshold {threshold} is below {fuzzy.MIN_THRESHOLD}, where accepted names need not share a key")
    formed = names.withColumn("_form", fuzzy.form(F.col(name), clean))
    # The form itself identifies a name here: whatever is written differently but compares equal is matched once.
    forms = formed.select(F.col("_form").alias("pos"), F.col("_form").alias("form")).filter(F.col("form") != "").distinct()
    refs = seeds.select(F.col("seed_pos").alias("pos"), fuzzy.form(F.col("seed"), False).alias("form"))
    best = _best_match(forms, refs, threshold, scorer)
    matched = best.join(seeds.select(F.col("seed_pos").alias("ref_pos"), "seed"), "ref_pos").select(
        F.col("pos").alias("_form"), "seed", F.bround("score", 0).cast("int").alias("_score")
    )
    return formed.join(matched, "_form", "left").select(
        *names.columns,
        F.coalesce("seed", name).alias("canonical_name"),
        F.coalesce("_score", F.lit(0)).alias("match_score"),
    )


# --- batch deduplication -------------------------------------------------------------------------------


def _settled_at_once(forms: DataFrame, threshold: int, scorer: str) -> tuple[DataFrame, DataFrame]:
    """Leaders and followers of at most ``SETTLE_ROWS`` forms, by the sequential loop inside one task."""

    def loop(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", ignore_index=True)
        follows = settled(rows["form"].tolist(), threshold, scorer)
        return pd.DataFrame({"pos": rows["pos"], "form": rows["form"], "ref_pos": rows["pos"].to_numpy()[follows]})

    done = cut(forms.select("pos", "form", F.lit(0).alias("all")).groupBy("all").applyInPandas(loop, "pos long, form string, ref_pos long"))
    return done.filter("ref_pos = pos").select("pos", "form"), done.filter("ref_pos <> pos").select("pos", "ref_pos")


def _in_turns(forms: DataFrame, threshold: int, scorer: str) -> tuple[DataFrame, DataFrame]:
    """Leaders of a slice and ``pos, ref_pos`` of its followers.

    Crowds such as numbered names hang together in chains as long as the slice, which parallel rounds would follow link by link. So while
    the earliest names have few leaders, those are settled in one task and all later names meet their leaders. Other names have short chains.
    """
    leaders, followers = [], []
    while not is_small(forms, SETTLE_ROWS):
        share = TURN_ROWS / forms.count()
        last = forms.select(F.percentile_approx("pos", min(share, 1.0), 100_000)).first()[0]
        new, led = _settled_at_once(forms.filter(F.col("pos") <= last), threshold, scorer)
        later = forms.filter(F.col("pos") > last)
        hits = cut(_first_match(later, new, threshold, scorer))
        leaders.append(new)
        followers += [led, hits]
        forms = cut(later.join(hits, "pos", "left_anti"))
        if not is_small(new, TURN_ROWS // 8):
            break
    new, led = _leader_rounds(forms, threshold, scorer)
    return reduce(DataFrame.unionByName, [*leaders, new]), reduce(DataFrame.unionByName, [*followers, led])


def _leader_rounds(forms: DataFrame, threshold: int, scorer: str) -> tuple[DataFrame, DataFrame]:
    """Leaders of a slice and ``pos, ref_pos`` of its followers.

    A name leads iff no earlier linked name leads. Each round settles every name whose earlier linked names allow it:
    one with an earlier leader follows, one whose earlier linked names all follow leads. Followers get their
    leader after the last round, because a nearer undecided name may still become one.
    """
    if is_small(forms, SETTLE_ROWS):
        return _settled_at_once(forms, threshold, scorer)
    links = cut(_keyed_pairs(forms, forms, threshold, scorer, earlier_only=True).select("pos", "ref_pos"))
    by_token = _token_is_enough(scorer, threshold)
    tokens = _token_rows(forms) if by_token else None

    def neighbours(state: DataFrame) -> DataFrame:
        known = state.select(F.col("pos").alias("ref_pos"), "status")
        found = links.join(known, "ref_pos").select(
            "pos",
            F.when(F.col("status") == _LEADER, F.col("ref_pos")).alias("leader"),
            F.when(F.col("status") == _UNDECIDED, F.col("ref_pos")).alias("waiting"),
        )
        if by_token:
            found = found.unionByName(_token_links(tokens, tokens.join(state, "pos")))
        lowest = found.groupBy("pos").agg(F.min("leader").alias("leader"), F.min("waiting").alias("waiting"))
        # The lowest position counts only when it is an earlier one.
        return lowest.select("pos", *[F.when(F.col(c) < F.col("pos"), F.col(c)).alias(c) for c in ("leader", "waiting")])

    def advance(state: DataFrame) -> DataFrame:
        settled = (
            F.when(F.col("status") != _UNDECIDED, F.col("status"))
            .when(F.col("leader").isNotNull(), _FOLLOWER)
            .when(F.col("waiting").isNull(), _LEADER)
            .otherwise(_UNDECIDED)
        )
        return state.join(neighbours(state), "pos", "left").select("pos", settled.alias("status"))

    state = forms.select("pos", F.lit(_UNDECIDED).alias("status"))
    # Each round settles at least the earliest undecided name.
    while not state.filter(F.col("status") == _UNDECIDED).isEmpty():
        state = cut(advance(state))
    leaders = forms.join(state.filter(F.col("status") == _LEADER), "pos", "left_semi").select("pos", "form")
    followers = state.filter(F.col("status") == _FOLLOWER).join(neighbours(state), "pos")
    return leaders, followers.select("pos", F.col("leader").alias("ref_pos"))


def _slices(forms: DataFrame, first_slice: int) -> list[tuple[int | None, int | None]]:
    """Position ranges that hold about ``first_slice`` names, then twice as many as all before, and so on."""
    total = forms.count()
    shares, size = [], first_slice
    while size < total:
        shares.append(size / total)
        size *= 2
    bounds = [None]
    if shares:
        cuts = forms.select(F.percentile_approx("pos", shares, 100_000)).first()[0]
        bounds += sorted(set(cuts))
    return list(zip(bounds, [*bounds[1:], None]))


def cluster(forms: DataFrame, threshold: int, scorer: str, first_slice: int = 1024, leaders: DataFrame | None = None) -> DataFrame:
    """``pos, ref_pos, score`` for every form of ``pos, form`` that follows an earlier one.

    ``leaders`` are representatives of an earlier batch, with lower places; they are matched before any of the forms.
    """
    known, parts = leaders, []
    for low, high in _slices(forms, first_slice):
        part = forms
        if low is not None:
            part = part.filter(F.col("pos") > low)
        if high is not None:
            part = part.filter(F.col("pos") <= high)
        if known is not None:
            hits = cut(_first_match(part, known, threshold, scorer))
            parts.append(hits)
            part = cut(part.join(hits, "pos", "left_anti"))
        new, followers = _in_turns(part, threshold, scorer)
        parts.append(followers)
        known = cut(new if known is None else known.unionByName(new))
    merged = reduce(DataFrame.unionByName, parts)
    every = forms.select("pos", "form") if leaders is None else forms.select("pos", "form").unionByName(leaders.select("pos", "form"))
    refs = every.select(F.col("pos").alias("ref_pos"), F.col("form").alias("ref_form"))
    pairs = merged.join(forms.select("pos", "form"), "pos").join(refs, "ref_pos")
    return _scored(pairs, scorer).select("pos", "ref_pos", "score")


def resolve_batch(
    names: DataFrame, seeds: DataFrame, threshold: int, scorer: str, clean: bool, first_slice: int
) -> DataFrame:
    """One row per distinct name: its seed match and, for names no seed changed, the name it merges into."""
    firsts = names.groupBy("name").agg(F.min("pos").alias("pos"))
    matched = cut(
        canonicalize(firsts, seeds, "name", threshold, scorer, clean).withColumn("form", fuzzy.form(F.col("name"), clean))
    )
    # A name that equals its seed stays open, as one that found none.
    is_open = (F.col("canonical_name") == F.col("name")) & (F.col("form") != "")
    forms = cut(
        matched.filter(is_open).groupBy("form").agg(F.min("pos").alias("pos"), F.min_by("name", "pos").alias("lead_name"))
    )
    merged = cluster(forms, threshold, scorer, first_slice)
    leads = forms.select(F.col("pos").alias("ref_pos"), F.col("lead_name").alias("ref_name"))
    by_form = (
        forms.join(merged, "pos", "left")
        .join(leads, "ref_pos", "left")
        .select(
            "form",
            F.coalesce("ref_name", "lead_name").alias("merged_name"),
            F.coalesce("ref_pos", "pos").alias("merged_pos"),
            F.coalesce(F.bround("score", 0).cast("int"), F.lit(100)).alias("merged_score"),
        )
    )
    open_form = F.when(is_open, F.col("form"))
    return (
        matched.withColumn("open_form", open_form)
        .join(by_form.withColumnRenamed("form", "open_form"), "open_form", "left")
        .select("name", "canonical_name", "match_score", "merged_name", "merged_pos", "merged_score")
    )


def dedup_batch(
    names: DataFrame, seeds: DataFrame, threshold: int = 85, scorer: str = "wratio", clean: bool = True,
    first_slice: int = 1024,
) -> DataFrame:
    """``name, canonical_name`` for every distinct name of a batch ``pos, name``.

    Names go to their seed; those no seed changes join the first earlier representative that scores at or above the
    threshold, else become one. The result equals the sequential loop in order of ``pos``.
    """
    rows = resolve_batch(names, seeds, threshold, scorer, clean, first_slice)
    return rows.select("name", F.coalesce("merged_name", "canonical_name").alias("canonical_name"))


def mapping_log(
    names: DataFrame, seeds: DataFrame, threshold: int = 85, scorer: str = "wratio", clean: bool = True,
    pairwise: bool = False, first_slice: int = 1024,
) -> DataFrame:
    """``step, pos, raw_name, canonical_name, match_score``: one row per lookup, and with ``pairwise`` one per merge.

    Every occurrence counts, repeated names too. A repeated representative merges into itself at 100.
    """
    lookup = ["step", "pos", "raw_name", "canonical_name", "match_score"]
    if not pairwise:
        rows = canonicalize(names, seeds, "name", threshold, scorer, clean)
        return rows.select(F.lit(0).alias("step"), "pos", F.col("name").alias("raw_name"), "canonical_name", "match_score")
    resolved = cut(resolve_batch(names, seeds, threshold, scorer, clean, first_slice))
    rows = names.select("pos", "name").join(resolved, "name").withColumnRenamed("name", "raw_name")
    merges = rows.filter(F.col("merged_pos") < F.col("pos")).select(
        F.lit(1).alias("step"), "pos", "raw_name",
        F.col("merged_name").alias("canonical_name"), F.col("merged_score").alias("match_score"),
    )
    return rows.withColumn("step", F.lit(0)).select(*lookup).unionByName(merges)


def apply_mapping(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Rewrite a name column, nested or not, by ``raw_name, canonical_name``; names without a mapping stay.

    The mapping is reduced to changed, distinct names first, so the join multiplies nothing and stays small; of several
    canonical names the first in code point order counts.
    """
    changes = (
        mapping.filter(F.col("raw_name") != F.col("canonical_name"))
        .groupBy(F.col("raw_name").alias("_raw"))
        .agg(F.min("canonical_name").alias("_canonical"))
    )
    joined = df.join(changes, F.col(column) == F.col("_raw"), "left")
    value = F.coalesce("_canonical", column)
    head, _, tail = column.partition(".")
    changed = F.col(head).withField(tail, value) if tail else value
    return joined.select(*[changed.alias(c) if c == head else c for c in df.columns])
