"""SQL expressions that read game text. No Python runs per row.

Like the scoring expressions, they take and give SQL text.
"""

from __future__ import annotations

# The tags that are kept.
HEADER_TAGS = ("White", "Black", "Date", "StartTime", "EndDate", "EndTime", "Link", "Result")
REQUIRED_TAGS = ("White", "Black", "Date", "StartTime", "EndDate", "EndTime", "Link")

# The leading block of tag lines. Possessive, so a long block cannot backtrack.
TAG_BLOCK = r"\A\s*((?:\[[^\n]*(?:\n\s*|\z))*+)"
TAG_LINE = r'(?m)^\s*\[([A-Za-z0-9][\w+#=:-]*)\s+"([^"\\\n]*(?:\\.[^"\\\n]*)*)"\s*\]'

# Brace comments, rest-of-line comments and escape lines. One pass from the left,
# so a brace inside a line comment, or the reverse, opens nothing.
COMMENT = r"(?m)\{[^}]*(?:\}|\z)|;[^\n]*|^%[^\n]*"
COMMENT_MARK = "~"

# Own choice: plies that share one digest of everything before them.
POSITION_BLOCK = 16

# Lines up to a blank one.
PARAGRAPH = r"\A\s*((?:[^\n]+(?:\n(?![ \t\r]*(?:\n|\z)))?)*+)"

INNERMOST = r"\([^()]*+\)"
PARENTHESIS_OR_RUN = r"[()]|[^()]+"

# One written move: castling, piece or pawn move, drop, or null move.
MOVE = (
    r"(?<![\w/-])"
    r"(?:O-O(?:-O)?|0-0(?:-0)?"
    r"|[KQRBN]?[a-h]?[1-8]?[x-]?[a-h][1-8](?:=?[QRBNKqrbnk])?"
    r"|[PNBRQK]?@[a-h][1-8]|--|Z0|0000|@@@@)"
    r"[+#]?(?![\w/])"
)


def _extract_all(text: str, pattern: str, group: int) -> str:
    return f"regexp_extract_all({text}, r'{pattern}', {group})"


def tag_block_sql(pgn: str = "pgn") -> str:
    return f"regexp_extract({pgn}, r'{TAG_BLOCK}', 1)"


def tag_names_sql(block: str) -> str:
    """Tags from the last to the first, so that the last of a repeated tag is found."""
    return f"reverse({_extract_all(block, TAG_LINE, 1)})"


def tag_values_sql(block: str) -> str:
    return f"reverse({_extract_all(block, TAG_LINE, 2)})"


def headers_sql(names: str, values: str) -> str:
    """Tag map. A repeated tag keeps its last value, and escapes are undone."""
    value = f"get({values}, CAST(array_position({names}, k) AS INT) - 1)"
    distinct = f"array_distinct({names})"
    return f"map_from_arrays({distinct}, transform({distinct}, k -> regexp_replace({value}, r'\\\\(.)', '$1')))"


def movetext_sql(pgn: str = "pgn") -> str:
    """Text after the tags, without comments, up to the blank line that ends a game."""
    rest = f"regexp_replace({pgn}, r'{TAG_BLOCK}', '')"
    bare = f"regexp_replace({rest}, r'{COMMENT}', '{COMMENT_MARK}')"
    return f"regexp_extract({bare}, r'{PARAGRAPH}', 1)"


def fold_parentheses_sql(text: str, passes: int = 4) -> str:
    """Text without the parentheses that hold no others, several times over. Each pass
    is one scan; texts without parentheses are not scanned."""
    folded = text
    for _ in range(passes):
        folded = f"regexp_replace({folded}, r'{INNERMOST}', ' ')"
    return f"CASE WHEN contains({text}, '(') THEN {folded} ELSE {text} END"


def mainline_sql(folded: str) -> str:
    """Folded text outside all parentheses that are left, at any depth of nesting.

    Those are deeper ones and ones without a partner. Only such texts take the walk,
    and it steps over whole runs between parentheses, not over characters.
    """
    depth = "CASE x WHEN '(' THEN s.depth + 1 WHEN ')' THEN greatest(s.depth - 1, 0) ELSE s.depth END"
    kept = "CASE WHEN s.depth = 0 AND x NOT IN ('(', ')') THEN concat(s.kept, ' ', x) ELSE s.kept END"
    walked = (
        f"aggregate({_extract_all(folded, PARENTHESIS_OR_RUN, 0)}, named_struct('depth', 0, 'kept', ''), "
        f"(s, x) -> named_struct('depth', {depth}, 'kept', {kept}), s -> s.kept)"
    )
    return f"CASE WHEN contains({folded}, '(') OR contains({folded}, ')') THEN {walked} ELSE {folded} END"


def move_tokens_sql(folded: str) -> str:
    """Ordered mainline moves as written, empty for text that is no game."""
    return _extract_all(mainline_sql(folded), MOVE, 0)


def plies_sql(tokens: str = "tokens", block: int = POSITION_BLOCK) -> str:
    """Each move with the key of the position after it: a digest of all moves so far.

    Moves are cut into blocks. A block's plies hash the digest of the blocks before
    it and the block's own moves up to them, so the work grows with the length of the
    game and not with its square.
    """
    last = f"greatest(size({tokens}) - 1, 0) div {block}"
    blocks = f"transform(sequence(0L, {last}), b -> slice({tokens}, CAST(b * {block} + 1 AS INT), {block}))"
    link = "md5(concat(element_at(done, -1), ' ', array_join(x, ' ')))"
    before = f"aggregate({blocks}, array(''), (done, x) -> concat(done, array({link})))"
    key = "md5(concat(z.`1`, ' ', array_join(slice(z.`0`, 1, i + 1), ' ')))"
    rows = f"transform(z.`0`, (t, i) -> named_struct('Move', t, 'position', {key}))"
    return f"flatten(transform(slice(arrays_zip({blocks}, {before}), 1, CAST({last} + 1 AS INT)), z -> {rows}))"
