"""SQL for DuckDB of the text queries that SQL can express, written apart from the operators."""

from __future__ import annotations

# What reads alike, character by character, written apart from the operator's table.
_FROM_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_TO_WIDE = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
_BLANKS = "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
_HYPHENS = "".join(map(chr, (0x2010, 0x2011, 0xFE63)))
_LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ"}
_FROM_LOOK = "ԁԛԝһӏԚԜҮϲϳϹͿօᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ" + "АВЕКМНОРСТУХаеорсухЅІЈѕіј" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧο" + "ЁёЇїЀѐӒӓӐӑӖӗӦӧӰӱ" + "ΆΈΊΌΎόΪΫ"
_TO_LOOK = "dqwhlQWYcjCJoABCDEHJKLMPRSTVWZ" + "ABEKMHOPCTYXaeopcyxSIJsij" + "ABEZHIKMNOPTYXo" + "ËëÏïÈèÄäĂăĔĕÖöŸÿ" + "ÁÉÍÓÝóÏŸ"
_INVISIBLE = r"[\x{AD}\x{34F}\x{61C}\x{180E}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}\x{FE00}-\x{FE0F}]"


def _skeleton(t: str) -> str:
    t = rf"regexp_replace({t}, '{_INVISIBLE}', '', 'g')"
    t = f"translate({t}, '{_FROM_WIDE}{_BLANKS}{_HYPHENS}', '{_TO_WIDE.replace(chr(39), chr(39) * 2)}{' ' * len(_BLANKS)}{'-' * len(_HYPHENS)}')"
    for a, b in _LIGATURES.items():
        t = f"replace({t}, '{a}', '{b}')"
    return f"nfc_normalize(translate(nfc_normalize({t}), '{_FROM_LOOK}', '{_TO_LOOK}'))"


_READING = f"""WITH r AS (SELECT DISTINCT ON (result_id) result_id, text FROM page_results WHERE text IS NOT NULL),
            a AS (SELECT result_id, text, {_skeleton('text')} AS k FROM r), v AS (SELECT * FROM a WHERE regexp_matches(k, '[^\\s\\pC\\pZ]'))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"{_READING} SELECT x.result_id AS result_id_a, y.result_id AS result_id_b FROM v x JOIN v y ON x.k = y.k AND x.result_id < y.result_id AND x.text <> y.text",
        "p1_classes": f"""{_READING}, c AS (SELECT k, min(result_id) AS class_id, count(DISTINCT text) AS n_texts, count(*) AS n FROM v GROUP BY k), t AS (SELECT k, text, count(*) AS n FROM v GROUP BY k, text)
            SELECT v.result_id, c.class_id, c.n_texts::BIGINT AS n_texts, (c.n - t.n)::BIGINT AS links FROM v JOIN c ON v.k = c.k JOIN t ON v.k = t.k AND v.text = t.text""",
        "p7_targets": """WITH t AS (SELECT mix_name, source, sum(target_weight) AS w FROM mix_targets WHERE mix_name IS NOT NULL AND source IS NOT NULL AND target_weight > 0 GROUP BY ALL),
            h AS (SELECT t.*, CASE WHEN source IN (SELECT source FROM documents WHERE source IS NOT NULL AND text <> '') THEN w END AS r FROM t)
            SELECT mix_name, source, round(w / sum(w) OVER (PARTITION BY mix_name), 12) AS target_share, round(r / sum(r) OVER (PARTITION BY mix_name), 12) AS reachable_share FROM h""",
    }
