"""Personal data replaced by surrogates, with built-in expressions only.

Entities are found by one pattern. Each distinct entity gets a surrogate of its own kind from a
keyed hash: a card number that passes its check digit, an address of the same class, a given
name of the same gender and script. Surrogates are checked against each other and against all
entities of the corpus, and drawn again until none collide, so different entities stay
different and no surrogate is somebody's real data. The same entity has the same surrogate
in every document and every spelling (case, spaces, dashes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import documents, row_key, saved

# Given names that are recognised, titles before a family name, and parts that
# surrogate names are made of, by script and gender.
GIVEN = {
    "latin_f": "Mary Anna Maria Sarah Laura Julia Emma Sophie Claire Marie Carmen Lucia Elena Petra Sabine Ursula Isabel Camille Alice Susan",
    "latin_m": "John James Robert Michael William David Thomas Peter Paul Jean Pierre Hans Karl Jose Juan Carlos Miguel Luis Henri Stefan",
    "cyrillic_f": "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия",
    "cyrillic_m": "Иван Пётр Алексей Сергей Дмитрий Андрей Николай Михаил Владимир Павел",
}
NEW_GIVEN = {
    "latin_f": "Adela Beata Celia Daria Edith Flora Greta Helga Irma Judith Klara Lydia Mona Nadia Odile Paula Rosa Selma Tessa Vera Wanda Yvonne Zora Agatha Bettina Corinne Doris Elsa Fiona Gilda",
    "latin_m": "Adam Bruno Conrad Denis Edgar Felix Gustav Hugo Igor Jonas Kurt Leon Marius Norbert Oskar Philip Quentin Ralf Simon Theo Urban Viktor Walter Xaver Yann Anton Boris Cyril Damian Erwin",
    "cyrillic_f": "Алла Вера Галина Дарья Евгения Жанна Зоя Инна Кира Лидия Майя Нина Полина Раиса Софья Тамара",
    "cyrillic_m": "Антон Борис Виктор Георгий Денис Егор Захар Игорь Кирилл Леонид Максим Олег Роман Степан Тимофей Фёдор",
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mademoiselle Señor Señora Господин Госпожа"
SYLLABLES = {
    "latin": "bar den fal gor hel jan kor lin mar nor pel rad sim tol var wen zan bel dor kes",
    "cyrillic": "бар ден фал гор хел кор лин мар нор пел рад сим тол вар зан бел дор кес тим лов",
}


def _either(words: str) -> str:
    return "(?:" + "|".join(words.split()) + ")"


_ANY_GIVEN = _either(" ".join(GIVEN.values()))
_START, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
# With inner capitals and apostrophes (McDonald, O'Brien), or in capitals; without a possessive 's. Repeated groups are
# possessive: others make the regex engine go one call deeper with each letter of a token.
_NAME = rf"\p{{Lu}}(?:\p{{L}}++|['’](?![Ss]{_END})\p{{Lu}})++"
_SPACE = "[ \u00a0]"
# An e-mail's name is looked for from where a run of its characters begins, after some marks at most, or close before
# the @: from everywhere else in the run, a long one would be read over and over.
_LOCAL = r"[A-Za-z0-9._%+\-]"
_IN_REACH = rf"(?:(?<=(?:^|[^A-Za-z0-9._%+\-])[._%+\-]{{0,8}})|(?={_LOCAL}{{1,64}}+@))"
PATTERNS = {
    "email": rf"(?=[A-Za-z0-9]){_IN_REACH}{_LOCAL}++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "phone": r"\+[1-9]\d{0,2}(?:[ .\-]?\(\d{1,4}\))?(?:[ .\-]?\d{2,4}){2,4}",
    "ip": r"(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "card": r"\d(?:[ \-]?\d){12,18}",
    "key": r"AKIA[0-9A-Z]{16}",
    "hex": r"(?=[a-fA-F]*+[0-9])(?=[0-9]*+[a-fA-F])[0-9a-fA-F]{16,}+",
    "given": rf"(?:{_ANY_GIVEN}|{_ANY_GIVEN.upper()})(?={_SPACE}{_NAME})",
    # The look ahead comes first: looking behind for all titles and names is dear. A title in
    # capitals goes with a name in capitals, so that 'MS Word' is none.
    "family": rf"(?=\p{{Lu}}[\p{{L}}'’])(?:(?<={_either(TITLES)}\.?{_SPACE})|(?<={_START}(?:{_ANY_GIVEN}|{_ANY_GIVEN.upper()}){_SPACE})|(?<={_START}{_either(TITLES).upper()}\.?{_SPACE})(?!\p{{L}}*\p{{Ll}})){_NAME}(?:-{_NAME})?",
}
PATTERN = _START + "(?:" + "|".join(PATTERNS.values()) + ")" + _END


# Longer names are replaced where a title or given name stands before them, and not looked for elsewhere.
LONGEST_NAME = 100


def _pattern_with(names: Column) -> Column:
    """The pattern that also finds these names (plain ones) by themselves, in any case but lower."""
    longest = F.reverse(F.array_sort(F.transform(names, lambda n: F.struct(F.length(n).alias("n"), n.alias("name")))))
    either = F.array_join(F.transform(longest, lambda x: F.replace(x["name"], F.lit("'"), F.lit("['’]"))), "|")
    bare = F.concat(F.lit(PATTERN[: -len(_END) - 1] + r"|(?=\p{Lu})(?iu:"), either, F.lit("))" + _END))
    return F.when(F.size(names) > 0, bare).otherwise(F.lit(PATTERN))


def _kind(entity: Column) -> Column:
    """Which pattern an entity is of; of a name also its gender and script."""
    kind = F.when(entity.contains("@"), "email").when(entity.startswith("+"), "phone")
    kind = kind.when(entity.rlike(r"^\d+(\.\d+){3}$"), "ip").when(entity.rlike(r"^[\d \-]+$"), "card")
    kind = kind.when(entity.rlike("^AKIA[0-9A-Z]{16}$"), "key")
    kind = kind.when(entity.rlike("^[0-9a-fA-F]{16,}$"), "hex")
    for name, words in GIVEN.items():
        kind = kind.when(F.lower(entity).isin(words.lower().split()), f"given_{name}")
    feminine = kind.when(F.lower(entity).rlike(r"^\p{IsCyrillic}.*[ая]$"), "family_cyrillic_f")
    return feminine.when(entity.rlike(r"^\p{IsCyrillic}"), "family_cyrillic").otherwise("family_latin")


def _plain(entity: Column, kind: Column) -> Column:
    """What has to agree for two mentions to be the same entity."""
    digits = F.regexp_replace(entity, r"\D", "")
    return F.when(kind.isin("phone", "card"), digits).otherwise(
        F.when(kind.isin("ip", "key"), entity).otherwise(F.translate(F.lower(entity), "’", "'"))
    )


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule over a string of digits, the last counted once."""

    def add(total: Column, x: Column) -> Column:
        return total + x

    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), add)


def _pick(draws: Column, i: Column | int, words: str) -> Column:
    """One of some words, by the i-th draw."""
    return F.element_at(F.array(*[F.lit(w) for w in words.split()]), F.get(draws, F.lit(i)) % len(words.split()) + 1)


def _like(text: Column, draws: Column) -> Column:
    """Letters for letters and digits for digits; the rest stays."""
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"

    def char(c: Column, i: Column) -> Column:
        draw = F.get(draws, i % F.size(draws)) + i * 7
        letter = F.substring(F.lit(letters), (draw % 26 + 1).cast("int"), F.lit(1))
        digit = F.substring(F.lit(digits), (draw % 10 + 1).cast("int"), F.lit(1))
        return F.when(c.rlike("[a-z]"), letter).when(c.rlike("[A-Z]"), F.upper(letter)).when(
            c.rlike("[0-9]"), digit
        ).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), char), "")


def _hex_like(text: Column, draws: Column) -> Column:
    chars = F.transform(
        F.split(text, ""),
        lambda _, i: F.substring(
            F.lit("0123456789abcdef"),
            # Another four bits of the same number after each 32 places.
            (F.floor(F.get(draws, i % 32) / F.pow(F.lit(16), F.floor(i / 32))) % 16 + 1).cast("int"),
            F.lit(1),
        ),
    )
    # A secret beyond the 128 digits that the draws hold goes on with hashes of them.
    more = F.transform(
        F.sequence(F.lit(1), F.greatest(F.ceil((F.length(text) - 128) / 64).cast("int"), F.lit(1))),
        lambda i: F.sha2(F.concat_ws(",", draws.cast("array<string>"), i.cast("string")), 256),
    )
    rest = F.substring(F.array_join(more, ""), F.lit(1), F.length(text) - 128)
    return F.when(
        F.length(text) > 128, F.concat(F.array_join(F.slice(chars, 1, 128), ""), rest)
    ).otherwise(F.array_join(chars, ""))


def _draws(secret: Column) -> Column:
    """32 numbers from 0 to 65535, by a hash of a string that begins with the key."""
    first, second = F.sha2(secret, 256), F.sha2(F.concat(secret, F.lit("|2")), 256)
    return F.transform(
        F.sequence(F.lit(0), F.lit(31)),
        lambda i: F.conv(
            F.substring(F.concat(first, second), (i * 4 + 1).cast("int"), F.lit(4)), 16, 10
        ).cast("int"),
    )


def _surrogate(kind: Column, plain: Column, attempt: Column) -> Column:
    """A surrogate for an entity in its plain form; another for each attempt.

    Where a form leaves few choices, later attempts widen it, so that there is always room.
    """
    draws = F.col("draws")
    host = F.col("host_draws")
    local = F.substring_index(plain, "@", 1)
    label = F.substring_index(F.substring_index(plain, "@", -1), ".", 1)
    email = F.concat(
        _like(local, draws),
        _like(F.repeat(F.lit("0"), F.greatest(attempt - 3, F.lit(0))), F.reverse(draws)),
        F.lit("@"), _like(label, host), F.lit(".example."), _pick(host, 31, "com net org")
    )
    area = F.when(F.length(plain) > 10, F.substring(plain, F.lit(1), F.length(plain) - 10)).otherwise(
        F.substring(plain, F.lit(1), F.lit(1))
    )
    national = F.substring(plain, F.length(area) + 1, F.length(plain))
    drawn = _like(F.substring(national, F.lit(2), F.length(national)), draws)
    # The exchange 555 is not given to anyone; a number that has it keeps it.
    unreal = (F.length(national) == 10) & (F.substring(national, F.lit(4), F.lit(3)) == "555")
    phone = F.concat(
        area,
        (F.get(draws, F.lit(30)) % 8 + 2).cast("string"),
        F.when(
            unreal & (attempt < 8),
            F.concat(F.substring(drawn, F.lit(1), F.lit(2)), F.lit("555"), F.substring(drawn, F.lit(6), F.lit(4))),
        ).otherwise(drawn),
    )
    octets = [(F.get(draws, F.lit(i)) % 254 + 1).cast("string") for i in range(4)]
    ip = (
        F.when(plain.startswith("10.") & (attempt < 8), F.concat_ws(".", F.lit("10"), *octets[1:]))
        .when(plain.startswith("192.168.") & (attempt < 8), F.concat_ws(".", F.lit("192.168"), *octets[2:]))
        .when(plain.startswith("127.") & (attempt < 8), F.concat_ws(".", F.lit("127"), *octets[1:]))
        .when(
            plain.rlike(r"^172\.(1[6-9]|2\d|3[01])\.") & (attempt < 8),
            F.concat_ws(".", F.lit("172"), (F.get(draws, F.lit(1)) % 16 + 16).cast("string"), *octets[2:]),
        )
        .otherwise(F.concat_ws(".", (F.get(draws, F.lit(0)) % 80 + 101).cast("string"), *octets[1:]))
    )
    body = F.concat(
        F.substring(plain, F.lit(1), F.lit(1)),
        _like(F.substring(plain, F.lit(2), F.length(plain) - 2), draws),
    )
    valid = _luhn(plain) % 10 == 0
    check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.concat(body, F.when(valid, check).otherwise((check + 1) % 10).cast("string"))
    value = (
        F.when(kind == "email", email)
        .when(kind == "phone", phone)
        .when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "key", F.concat(F.lit("AKIA"), _like(F.substring(plain, F.lit(5), F.lit(16)), draws)))
        .when(kind == "hex", _hex_like(plain, draws))
    )
    for name, words in NEW_GIVEN.items():
        # After a few draws all names may be taken; two joined ones are not.
        one = _pick(draws, 0, words)
        two = F.concat(one, F.lit("-"), _pick(draws, 1, words))
        value = value.when(
            kind == f"given_{name}", F.lower(F.when(attempt < 8, one).otherwise(two))
        )

    def family(script: str, ending: str) -> Column:
        # More syllables the more often it collided, so there is always room.
        n = F.least(F.lit(2) + attempt, F.lit(12)).cast("int")
        parts = F.transform(F.sequence(F.lit(2), n + 1), lambda i: F.element_at(
            F.array(*[F.lit(w) for w in SYLLABLES[script].split()]),
            F.get(draws, i) % len(SYLLABLES[script].split()) + 1,
        ))
        return F.concat(F.array_join(parts, ""), F.lit(ending))

    return (
        value.when(kind == "family_cyrillic_f", family("cyrillic", "ова"))
        .when(kind == "family_cyrillic", family("cyrillic", "ов"))
        .otherwise(family("latin", ""))
    )


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """`entities` (kind, plain, attempt) with a surrogate each."""
    secret = F.concat_ws("|", F.lit(key), "kind", "plain", F.col("attempt").cast("string"))
    host = F.concat_ws("|", F.lit(key), F.lit("host"), F.substring_index("plain", "@", -1))
    return (
        entities.withColumn("draws", _draws(secret))
        .withColumn("host_draws", _draws(host))
        .withColumn("surrogate", _surrogate(F.col("kind"), F.col("plain"), F.col("attempt")))
        .select("kind", "plain", "attempt", "surrogate")
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, plain, surrogate) of distinct `entities` (kind, plain): no surrogate twice in a
    kind, none that is an entity of that kind.

    Each round draws for what is still without. Of entities that drew the same surrogate the
    smallest keeps it, unless an earlier round gave it away or it is an entity itself; only
    the losers go on.
    """
    originals = saved(entities.select("kind", "plain").distinct(), "entities")
    taken = originals.withColumnRenamed("plain", "surrogate")
    done, left = None, originals.withColumn("attempt", F.lit(0))
    # Few bytes, but much to compute for each: dealt out evenly, however small the files are.
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        drawn = saved(_drawn(left.repartition(tasks, "kind", "plain"), key), "drawn")
        best = (
            drawn.groupBy("kind", "surrogate")
            .agg(F.min("plain").alias("plain"))
            .join(taken, ["kind", "surrogate"], "left_anti")
        )
        won = saved(best.select("kind", "plain", "surrogate"), "won")
        done = won if done is None else done.union(won)
        left = drawn.join(won, ["kind", "plain"], "left_anti").select(
            "kind", "plain", (F.col("attempt") + 1).alias("attempt")
        )
        if left.isEmpty():
            return done
        left = saved(left, "left")
        taken = taken.union(won.select("kind", "surrogate"))


def _rendered(entity: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the spelling of the mention: its separators, its case."""
    digits = F.split(surrogate, "")
    # Each digit of the mention gives way to the next of the surrogate.
    filled = F.aggregate(
        F.split(entity, ""),
        F.struct(F.lit("").alias("text"), F.lit(0).alias("n")),
        lambda seen, c: F.struct(
            F.concat(seen["text"], F.when(c.rlike(r"\d"), F.get(digits, seen["n"])).otherwise(c)).alias("text"),
            (seen["n"] + F.when(c.rlike(r"\d"), 1).otherwise(0)).alias("n"),
        ),
        lambda seen: seen["text"],
    )
    cased = (
        F.when(entity == F.lower(entity), surrogate)
        .when(entity == F.upper(entity), F.upper(surrogate))
        .when(kind.startswith("given") | kind.startswith("family"), F.initcap(F.replace(surrogate, F.lit("-"), F.lit(" "))))
        .otherwise(surrogate)
    )
    cased = F.when(surrogate.contains("-") & kind.startswith("given"), F.replace(cased, F.lit(" "), F.lit("-"))).otherwise(cased)
    return F.when(kind.isin("phone", "card"), filled).when(kind.isin("ip", "key"), surrogate).otherwise(cased)


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_entities, n_distinct) of every row of `docs` (doc_id, text): the text with
    every entity replaced, how many there were, and how many different ones.

    Recognised are e-mail addresses, phone numbers with a country code, IPv4 addresses, card and
    account numbers of 13 to 19 digits, access keys and hexadecimal secrets, given names
    before a family name, and family names after a title or a given name. A name found so is
    replaced wherever the same text has it again, by itself too, unless in lower case. Names of one
    person keep belonging together, as given and family names are mapped by themselves.

    An entity that very many documents hold is counted once a document and is a hot key of one
    join only, which AQE splits. Texts are searched once, and those with entities once more; all
    are shuffled once, evenly, to meet their surrogates. Whoever has `key` can
    recompute surrogates, but not turn them back.

    NULL and empty texts stay as they are. Rows without doc_id are treated like others. Identical
    rows give equal results.
    """
    # Two hashes of the text say which row it is; equal texts have equal surrogates.
    keyed = documents(docs).withColumns(
        {"row": row_key(), "row2": F.xxhash64(F.lit(1), F.coalesce("text", F.lit("")))}
    )
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(PATTERN), 0)
    mentions = saved(
        keyed.select("row", "row2", F.explode(found).alias("entity"))
        .withColumn("kind", _kind(F.col("entity")))
        .select("row", "row2", "kind", _plain(F.col("entity"), F.col("kind")).alias("plain"))
        .distinct(),
        "mentions",
    )
    table = surrogate_table(mentions, key)
    # Written, so that copies of one text are a hot key of a join that AQE can split.
    maps = saved(
        mentions.join(table, ["kind", "plain"])
        .groupBy("row", "row2")
        .agg(
            F.map_from_entries(
                F.collect_set(F.struct(F.concat_ws("|", "kind", "plain"), "surrogate"))
            ).alias("map"),
            # No pattern is made of a token of thousands of letters.
            F.collect_set(
                F.when(F.col("kind").rlike("^(given|family)") & (F.length("plain") <= LONGEST_NAME), F.col("plain"))
            ).alias("names"),
        )
        .withColumn("pattern", _pattern_with(F.col("names")))
        .drop("names"),
        "maps",
    )

    def replaced(entity: Column) -> Column:
        def known(kind: Column) -> Column:
            held = F.element_at(F.col("map"), F.concat_ws("|", kind, _plain(entity, kind)))
            return F.transform(F.array(held), lambda s: _rendered(entity, kind, s)).getItem(0)

        return F.coalesce(F.transform(F.array(_kind(entity)), known).getItem(0), entity)

    pieces = F.arrays_zip(
        F.split("text", F.col("pattern"), -1).alias("before"),
        F.transform("entities", replaced).alias("new"),
    )
    joined = F.array_join(
        F.transform(pieces, lambda p: F.concat(p["before"], F.coalesce(p["new"], F.lit("")))), ""
    )
    # Only a text that has a map is searched again.
    has = F.col("map").isNotNull()
    return (
        keyed.join(maps.hint("merge"), ["row", "row2"], "left")  # the same join at every size
        .withColumn("entities", F.when(has, F.regexp_extract_all("text", F.col("pattern"), F.lit(0))))
        .select(
            "doc_id",
            F.when(has, joined).otherwise(F.col("text")).alias("text"),
            F.when(has, F.size("entities")).otherwise(0).alias("n_entities"),
            F.when(has, F.size("map")).otherwise(0).alias("n_distinct"),
        )
    )
