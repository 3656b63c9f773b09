"""SQL fragments shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from seqprep.functions.text import WHITESPACE

# The same white space and special characters, in RE2 syntax.
SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPECIALS = r"""[*"\n…+\-/=()''•:\[\]|!;]"""
_BLANKS = WHITESPACE.replace("'", "''")


def strip(text: str) -> str:
    return f"trim({text}, '{_BLANKS}')"


def strip_special(text: str) -> str:
    return f"regexp_replace({text}, '{SPECIALS}', ' ', 'g')"


def collapse(text: str, mark: str) -> str:
    return f"regexp_replace({text}, '[{mark}]+', '{mark}', 'g')"


def normalize(text: str) -> str:
    text = collapse(strip_special(strip(text)), " ")
    for mark in "!,?":
        text = collapse(text, mark)
    return f"lower({text})"


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{SPACES}+'), lambda x: x <> '')"


def tok13a(text: str) -> str:
    for old, new in (
        ("'<skipped>'", "''"),
        ("'-' || chr(10)", "''"),
        ("chr(10)", "' '"),
        ("'&quot;'", "'\"'"),
        ("'&amp;'", "'&'"),
        ("'&lt;'", "'<'"),
        ("'&gt;'", "'>'"),
    ):
        text = f"replace({text}, {old}, {new})"
    text = f"' ' || {text} || ' '"
    for pattern, new in (
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
        (r"([^0-9])([\.,])", r"\1 \2 "),
        (r"([\.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return words(f"({text})")


def ids_text(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


# Pairs of a user turn and the assistant turn after it.
PAIRS = """
  pairs AS (
    SELECT u.conv_id * 4294967296 + u.turn AS id,
           CASE u.conv_id % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS split,
           u.text AS source, a.text AS target
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant')"""


def vocab(texts: str, size: int | None = None, name: str = "vocab") -> str:
    """CTE of a vocabulary over ``texts``, a query with one word-list column w."""
    top = "" if size is None else f"WHERE rn <= {size - 4}"
    return f"""
  {name} AS (
    SELECT token, (3 + rn)::INT AS token_id, freq FROM (
      SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) AS rn FROM (
        SELECT token, count(*) AS freq FROM (SELECT unnest(w) AS token FROM ({texts}))
        WHERE token NOT IN ('<pad>', '<unk>', '<bos>', '<eos>') GROUP BY token)) {top}
    UNION ALL SELECT * FROM (VALUES ('<pad>', 0, 0), ('<unk>', 1, 0), ('<bos>', 2, 0), ('<eos>', 3, 0)))"""


def encoded(name: str, base: str, text: str, room: int | None, vocab_name: str = "vocab") -> str:
    """CTE (id, ids): ids of the first ``room`` words, without end id or padding."""
    cut = words(text) if room is None else f"({words(text)})[1:{room}]"
    return f"""
  {name} AS (
    SELECT b.id, coalesce(e.ids, []) AS ids FROM {base} b LEFT JOIN (
      SELECT p.id, list(coalesce(v.token_id, 1) ORDER BY p.pos) AS ids FROM (
        SELECT id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
        FROM (SELECT id, {cut} AS w FROM {base})) p
      LEFT JOIN {vocab_name} v USING (token) GROUP BY p.id) e USING (id))"""


def pad(ids: str, n: int | str, value: int = 0) -> str:
    return f"list_concat({ids}, list_transform(range(greatest({n} - len({ids}), 0)::BIGINT), lambda _x: {value}))"


def ngrams(words_col: str, n: int) -> str:
    return (
        f"list_transform(range(1, greatest(len({words_col}) - {n} + 2, 1)::BIGINT), "
        f"lambda i: array_to_string({words_col}[i:i + {n} - 1], ' '))"
    )


def ngram_sums(hyp: str, refs: str, by: str = "") -> str:
    """CTE ``sums`` over CTE ``pair(id, [by,] h, r)`` of word lists: m1..m4, t1..t4, hyp_len, ref_len."""
    grams = " UNION ALL ".join(
        f"SELECT id, {side} AS side, {n} AS n, unnest({ngrams(col, n)}) AS g FROM pair"
        for n in (1, 2, 3, 4)
        for side, col in ((0, hyp), (1, refs))
    )
    key = f"{by}, " if by else ""
    join = f"JOIN (SELECT id, {by} FROM pair) USING (id)" if by else ""
    total = f"GROUP BY {by}" if by else ""
    sums = ", ".join(
        [f"coalesce(sum(least(h, r)) FILTER (WHERE n = {n}), 0)::BIGINT AS m{n}" for n in (1, 2, 3, 4)]
        + [f"coalesce(sum(h) FILTER (WHERE n = {n}), 0)::BIGINT AS t{n}" for n in (1, 2, 3, 4)]
        + ["coalesce(sum(h) FILTER (WHERE n = 1), 0)::BIGINT AS hyp_len"]
        + ["coalesce(sum(r) FILTER (WHERE n = 1), 0)::BIGINT AS ref_len"]
    )
    return f"""
  grams AS ({grams}),
  counted AS (
    SELECT id, n, g, count(*) FILTER (WHERE side = 0) AS h, count(*) FILTER (WHERE side = 1) AS r
    FROM grams GROUP BY id, n, g),
  sums AS (SELECT {key}{sums} FROM counted {join} {total})"""


BREVITY = "CASE WHEN hyp_len = 0 OR ref_len = 0 THEN 0 WHEN hyp_len > ref_len THEN 1 ELSE exp(1 - ref_len / hyp_len) END"
BLEU = (
    "CASE WHEN least(m1, m2, m3, m4) = 0 THEN 0 ELSE "
    f"({BREVITY}) * exp((ln(m1 / t1) + ln(m2 / t2) + ln(m3 / t3) + ln(m4 / t4)) / 4) END"
)
