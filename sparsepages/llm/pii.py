"""Surrogates for personal data, in DataFrame operations only.

Detected mentions are e-mail addresses, IPv4 addresses, telephone and card
numbers, secrets behind a telling name, and persons behind a title. Every entity
gets one replacement by a keyed permutation of the forms of its class, persons by
a keyed digest, so all mentions of it agree; the replacement keeps the mention's
lengths, separators, letter case, script, check digit and, with persons, gender.
Replacements that meet each other or a real entity are made again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import if_small, settle

# Titles by gender and script, and the names that stand in.
TITLES = {
    ("f", "latin"): "Mrs|Ms|Miss|Madam|Mme|Madame|Mademoiselle|Frau|Señora|Señorita|Sra|Signora",
    ("m", "latin"): "Mr|Sir|Monsieur|Herr|Señor|Sr|Signor",
    ("f", "cyrillic"): "госпожа|Госпожа|г-жа",
    ("m", "cyrillic"): "господин|Господин|г-н",
}
GIVEN = {
    ("f", "latin"): "Anna Clara Emma Eva Greta Helen Ida Julia Laura Lena Maria Nora Paula Rosa Sara Vera",
    ("m", "latin"): "Adam Anton Carl David Emil Felix Hugo Jan Leo Lucas Max Oscar Paul Simon Tom Victor",
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга",
    ("m", "cyrillic"): "Антон Борис Виктор Иван Лев Максим Олег Павел",
}
FAMILY = {
    ("f", "latin"): "Abel Bauer Berger Brandt Carver Costa Duval Fabre Fischer Garner Hale Lambert Lang Marin Moreau Navarro Palmer Roth Serrano Vidal",
    ("m", "latin"): "Abel Bauer Berger Brandt Carver Costa Duval Fabre Fischer Garner Hale Lambert Lang Marin Moreau Navarro Palmer Roth Serrano Vidal",
    ("f", "cyrillic"): "Белова Волкова Громова Зайцева Лебедева Морозова Орлова Соколова",
    ("m", "cyrillic"): "Белов Волков Громов Зайцев Лебедев Морозов Орлов Соколов",
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "secret": r"""(?<=(?i:token|secret|password|passwd|api.?key|access.?key)["']{0,1}\s{0,3}[:=]\s{0,3}["']{0,1})(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{12,}+""",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*+@[A-Za-z0-9](?:[A-Za-z0-9-]*+\.)+[A-Za-z]{2,}",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "card": r"(?<![\w.])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\w]|\.\d)",
    "person": r"(?<=(?<!\p{L})(?:" + "|".join(TITLES.values()) + r")\.{0,1} )\p{Lu}[\p{L}'-]++(?: \p{Lu}[\p{L}'-]++)?",
}
# What every mention of a kind holds, cheaper to look for than the mention; most texts have none of them.
_NEEDED = {
    "secret": r"(?i:token|secret|passw|api.?key|access.?key)",
    "email": "@",
    "ip": r"\d\.\d",
    "phone": r"[+(]|\d[.-]\d",
    "card": r"\d{4}[ -]\d{4}|\d{13}",
    "person": r"(?<!\p{L})(?:" + "|".join(TITLES.values()) + r")\.? \p{Lu}",
}
_HINT = "|".join(_NEEDED[kind] for kind in PATTERNS)
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_KEY = "sparsepages"


def _kind(mention: Column, title: Column) -> Column:
    whole = lambda name: mention.rlike(f"^(?:{PATTERNS[name]})$")
    return (
        F.when(mention.contains("@"), "email")
        .when(whole("ip"), "ip")
        .when(whole("phone"), "phone")
        .when(whole("card"), "card")
        .when(mention.rlike(r"^\p{Lu}[\p{L}'-]+( \p{Lu}[\p{L}'-]+)?$") & title.isNotNull(), F.concat(F.lit("person:"), title))
        .otherwise("secret")
    )


def _normal(mention: str, kind: str) -> Column:
    """What all mentions of one entity have in common."""
    return F.expr(f"case when {kind} in ('phone', 'card') then regexp_replace({mention}, '[^0-9]', '') when {kind} = 'email' then lower({mention}) else {mention} end")


def _luhn_sum(digits: str, first: int) -> str:
    """Sum of the check rule over ``digits`` from the right; ``first`` is 1 if the last digit is doubled, else 0."""
    d = f"cast(substr({digits}, length({digits}) - i, 1) as int)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (s, i) -> s + if(i % 2 = {first}, {d}, if(2 * {d} > 9, 2 * {d} - 9, 2 * {d})))"


def _pick(words: str, at: str) -> str:
    names = ", ".join(f"'{w}'" for w in words.split())
    return f"array({names})[{at} % {len(words.split())}]"


ROUNDS = 6  # of the permutation
ATTEMPTS = 32  # to miss the real forms of other entities
DENSE = 8  # a class with more entities than one form in so many has no room to miss them


def _cells(rows: DataFrame) -> DataFrame:
    """``rows`` (``kind, normal``) with ``chars``, the parts of the normal form, and ``cells``: value, number of values, and half of each part.

    Parts with one value stay as they are. Forms with the same parts of one value
    and the same numbers of values are a ``form``, which has ``room`` for so many.
    """
    c = "substr(normal, i, 1)"
    hexa = "kind = 'secret' and normal rlike '^[0-9a-f]+$'"
    fixed = (
        "(kind = 'email' and i > length(normal) - length(substring_index(normal, chr(46), -1)))"
        " or (kind in ('phone', 'card') and i = 1) or (kind = 'card' and i = length(normal))"
    )
    cell = (
        f"case when {fixed} then struct(0 as x, 1 as r, i % 2 as half)"
        f" when {hexa} then struct(instr('0123456789abcdef', {c}) - 1 as x, 16 as r, i % 2 as half)"
        f" when {c} rlike '[0-9]' then struct(ascii({c}) - 48 as x, 10 as r, i % 2 as half)"
        f" when {c} rlike '[a-z]' then struct(ascii({c}) - 97 as x, 26 as r, i % 2 as half)"
        f" when {c} rlike '[A-Z]' then struct(ascii({c}) - 65 as x, 26 as r, i % 2 as half)"
        " else struct(0 as x, 1 as r, i % 2 as half) end"
    )
    octet = (
        "case length(o) when 1 then struct(cast(o as int) as x, 10 as r, i % 2 as half)"
        " when 2 then struct(cast(o as int) - 10 as x, 90 as r, i % 2 as half) else struct(cast(o as int) - 100 as x, 156 as r, i % 2 as half) end"
    )
    every = "sequence(1, length(normal))"
    return (
        rows.withColumn("chars", F.expr(f"if(kind = 'ip', split(normal, '[.]'), transform({every}, i -> {c}))"))
        .withColumn("cells", F.expr(f"if(kind = 'ip', transform(split(normal, '[.]'), (o, i) -> {octet}), transform({every}, i -> {cell}))"))
        .withColumn("form", F.expr("concat_ws('|', kind, array_join(zip_with(cells, chars, (c, o) -> if(c.r = 1, o, cast(c.r as string))), ','))"))
        .withColumn("room", F.expr("aggregate(cells, 1D, (n, c) -> n * c.r)"))
    )


def _drawn(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (``kind, normal, attempt``) with ``form``, ``room`` and ``surrogate``, the replacement of the normal form.

    A name is drawn from a keyed digest. Every other form goes through a keyed
    permutation of the forms of its class: in each round the values of one half
    of the parts are shifted by a digest of the other half, so different forms
    stay different.
    """
    secret = key.replace("'", "''")
    rows = _cells(rows)
    for k in range(ROUNDS):
        other = f"array_join(transform(filter(cells, c -> c.half <> {k % 2}), c -> cast(c.x as string)), ',')"
        digest = f"sha2(concat_ws('|', '{secret}', form, cast(attempt as string), '{k}', {other}), 512)"
        noise = f"flatten(array_repeat(regexp_extract_all({digest}, '....', 0), cast(size(cells) div 32 + 1 as int)))"
        shifted = f"(c.x + if(c.half = {k % 2}, cast(conv(n, 16, 10) as int), 0)) % c.r"
        rows = rows.withColumn("cells", F.expr(f"zip_with(cells, slice({noise}, 1, size(cells)), (c, n) -> struct({shifted} as x, c.r as r, c.half as half))"))
    shown = (
        "array_join(zip_with(cells, chars, (c, o) -> case when c.r = 1 then o when c.r = 16 then substr('0123456789abcdef', c.x + 1, 1)"
        " when c.r = 10 then cast(c.x as string) when o rlike '[a-z]' then chr(97 + c.x) else chr(65 + c.x) end), '')"
    )
    ip = "array_join(transform(cells, c -> cast(c.x + case c.r when 10 then 0 when 90 then 10 else 100 end as string)), '.')"
    n = "cast(conv(substr(noise, {}, 6), 16, 10) as int)"
    person = "case " + " ".join(
        # After some attempts a further family name is joined on, so that names never run out.
        f"when kind = 'person:{g}-{s}' then concat(if(contains(normal, ' '), concat({_pick(GIVEN[g, s], n.format(1))}, ' '), ''),"
        f" array_join(transform(sequence(0, cast(least(attempt, 16) as int)), i -> {_pick(FAMILY[g, s], 'cast(conv(substr(noise, 7 + 6 * i, 6), 16, 10) as int)')}), '-'))"
        for g, s in GIVEN
    ) + " end"
    rows = rows.withColumn("noise", F.expr(f"sha2(concat_ws('|', '{secret}', kind, normal, cast(attempt as string)), 512)"))
    rows = rows.withColumn("shown", F.expr(shown)).withColumn("body", F.expr("substr(shown, 1, length(shown) - 1)"))
    card = f"concat(body, cast((10 - {_luhn_sum('body', 1)} % 10) % 10 as string))"
    return rows.withColumn(
        "surrogate",
        F.when(F.col("kind") == "card", F.expr(card))
        .when(F.col("kind") == "ip", F.expr(ip))
        .when(F.col("kind").startswith("person"), F.expr(person))
        .otherwise(F.col("shown")),
    ).drop("noise", "body", "shown", "cells", "chars")


def surrogates(entities: DataFrame, key: str = _KEY) -> DataFrame:
    """``kind, normal, surrogate`` for distinct ``kind, normal``; no two entities share a replacement.

    Nor is a replacement the form of a real entity, as long as its class of forms
    has room: proposals that are taken or a real form are made again, by another
    permutation, ``ATTEMPTS`` times at most. In classes with more entities than one
    form in ``DENSE``, and where proposals are still left, the permutation's values
    stand: they differ from each other, but may be the form of another entity (with
    all 10,000 addresses of four one-digit numbers there is no other way). Names
    left over stand with 17 family names. Genders share one pool of names.
    """
    pool = F.element_at(F.split("kind", ":"), 1)
    real = settle(entities.select("kind", "normal").distinct().withColumn("pool", pool))
    first = settle(_drawn(real.withColumn("attempt", F.lit(0)), key))
    sizes = first.groupBy("form").agg(F.count("*").alias("n"), F.max("room").alias("room"))
    dense = settle(sizes.filter(~F.col("form").startswith("person") & (F.col("n") * DENSE > F.col("room"))).select("form"))
    out = ["kind", "normal", "pool", "form", "surrogate"]
    full = first.join(dense, "form", "left_semi").select(*out)
    now, done = first.join(dense, "form", "left_anti").select(*out), None
    for attempt in range(1, ATTEMPTS + 1):
        owner = now.groupBy("pool", "surrogate").agg(F.min(F.struct("normal", "kind")).alias("owner"))
        taken = real.select("pool", F.col("normal").alias("surrogate"))
        if done is not None:
            taken = taken.unionByName(done.select("pool", "surrogate"))
        judged = now.join(owner, ["pool", "surrogate"]).join(taken.distinct().withColumn("taken", F.lit(True)), ["pool", "surrogate"], "left")
        judged = settle(judged.withColumn("again", F.col("taken").isNotNull() | (F.struct("normal", "kind") != F.col("owner"))).select(*out, "again"))
        kept = judged.filter("not again").select(*out)
        done = kept if done is None else done.unionByName(kept)
        rest = judged.filter("again")
        if not rest.limit(1).count():
            return full.unionByName(done).select("kind", "normal", "surrogate")
        now = settle(_drawn(rest.select("kind", "normal", "pool").withColumn("attempt", F.lit(attempt)), key).select(*out))
    people = F.col("form").startswith("person")
    left = now.filter(~people).select("form").distinct()
    whole = first.join(left, "form", "left_semi").select(*out)
    return full.unionByName(done.join(left, "form", "left_anti")).unionByName(whole).unionByName(now.filter(people)).select("kind", "normal", "surrogate")


def _laid_out(mention: str, kind: str, surrogate: str) -> Column:
    """The replacement in the form of the mention: digits in its separators, letters in its case."""
    digits_before = f"length(regexp_replace(substr({mention}, 1, i), '[^0-9]', ''))"
    laid = (
        f"array_join(transform(sequence(1, length({mention})), i -> if(substr({mention}, i, 1) rlike '[0-9]',"
        f" substr({surrogate}, {digits_before}, 1), substr({mention}, i, 1))), '')"
    )
    return F.expr(f"case when {kind} in ('phone', 'card') then {laid} when {kind} = 'email' and {mention} = upper({mention}) then upper({surrogate}) else {surrogate} end")


def pseudonymised(docs: DataFrame, key: str = _KEY) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and a column ``pii`` of ``kind, surrogate`` in order.

    All rows and columns stay (a column ``pii`` is replaced); null and empty texts
    stay as they are with an empty list. Card numbers whose check digit is wrong
    are left alone. Rows are told apart by their place, so null or repeated ids
    and repeated rows do no harm.

    Only texts with a mention are shuffled. The replacements are broadcast if they
    are few, else joined by shuffle; an entity in very many documents is split by
    the skew join. A family name alone behind a title takes the surrogate of the
    one full name with this title's gender that ends in it in the same document.
    """
    others = [c for c in docs.columns if c != "pii"]
    rows = docs.select(F.struct(*others).alias("doc"), F.monotonically_increasing_id().alias("row"))
    some = F.coalesce(F.col("doc.text").rlike(_HINT), F.lit(False))
    found = F.when(some, F.regexp_extract_all("doc.text", F.lit(_ANY), 0)).otherwise(F.array().cast("array<string>"))
    # Texts with a mention, taken apart once: mentions and gaps hold all of them.
    listed = rows.filter(some).withColumn("pattern", F.lit(_ANY)).withColumn("mentions", F.regexp_extract_all("doc.text", F.lit(_ANY), 0))
    listed = listed.filter("size(mentions) > 0").withColumn("gaps", F.expr("split(doc.text, pattern, -1)")).drop("pattern")
    listed = settle(listed.withColumn("doc", F.col("doc").withField("text", F.lit(None).cast("string"))))
    title = F.lit(None).cast("string")
    for (gender, script), names in TITLES.items():
        title = F.when(F.col("ahead").rlike(rf"(?<!\p{{L}})(?:{names})\.? $"), f"{gender}-{script}").otherwise(title)
    each = listed.select("row", F.posexplode(F.arrays_zip("mentions", F.expr("slice(gaps, 1, size(mentions))").alias("gaps"))).alias("at", "m")).select(
        "row", "at", F.col("m.mentions").alias("mention"), F.expr("right(m.gaps, 16)").alias("ahead")
    )
    each = each.withColumn("kind", _kind(F.col("mention"), title)).withColumn("normal", _normal("mention", "kind"))
    genuine = (F.col("kind") != "card") | F.expr(f"{_luhn_sum('normal', 0)} % 10 = 0")
    each = settle(each.withColumn("kind", F.when(genuine, F.col("kind"))).drop("ahead"))
    people = each.filter(F.col("kind").startswith("person"))
    last = F.substring_index("normal", " ", -1)
    whole = people.filter(F.col("normal").contains(" ")).groupBy("row", "kind", last.alias("family")).agg(F.min("normal").alias("low"), F.max("normal").alias("high"))
    whole = whole.filter("low = high").select("row", "kind", F.col("family").alias("normal"), F.col("low").alias("whole"))
    each = settle(each.join(whole, ["row", "kind", "normal"], "left").withColumn("normal", F.coalesce("whole", "normal")))
    named = if_small(surrogates(each.filter("kind is not null"), key), F.octet_length("normal") + F.octet_length("surrogate") + 64)
    put = F.when(F.col("surrogate").isNull(), F.col("mention")).when(F.col("whole").isNotNull(), F.substring_index("surrogate", " ", -1))
    replaced = (
        each.join(named, ["kind", "normal"], "left")
        .withColumn("put", put.otherwise(_laid_out("mention", "kind", "surrogate")))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("at", "kind", "put"))).alias("put"))
    )
    glued = F.concat(F.col("gaps")[0], F.array_join(F.expr("transform(put, (p, i) -> concat(p.put, gaps[i + 1]))"), ""))
    pii = F.expr("transform(filter(put, p -> p.kind is not null), p -> struct(split(p.kind, ':')[0] as kind, p.put as surrogate))")
    changed = listed.join(replaced, "row").select(F.col("doc").withField("text", glued).alias("doc"), pii.alias("pii"))
    empty = F.array().cast("array<struct<kind:string,surrogate:string>>")
    same = rows.filter(F.size(found) == 0).select("doc", empty.alias("pii"))
    return same.unionByName(changed).select("doc.*", "pii")
