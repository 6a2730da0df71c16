"""Request text checks."""

import random

import pytest

from geoloom.plans.guard import FORBIDDEN_WORDS, FUNCTIONS, check_field, check_identifier, check_where, parse_ids, parse_integer
from geoloom.plans.feature_query import FeatureQuery
from geoloom.functions.times import parse_instant

class Clauses:
    """Random conditions from a small grammar, as lists of tokens. Quoted tokens hold any marks and words; the others hold none."""

    COLUMNS = ("speed", "kind", "seen", "last_update", "selected", "unions")

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def text(self, quote: str) -> str:
        inside = self.rng.choices([" ", "x", "9", ";", "--", "/*", "*/", "(", ")", "$t$", "\n", "%", *FORBIDDEN_WORDS, quote * 2, *(["\\\\", "\\" + quote] if quote != "`" else [])], k=self.rng.randint(1, 6))
        return quote + "".join(inside) + quote

    def name(self) -> str:
        return self.rng.choice(self.COLUMNS) if self.rng.random() < 0.7 else self.text("`")

    def value(self, depth: int) -> list[str]:
        pick = self.rng.randrange(5)
        if pick == 0:
            return [self.text("'")]
        if pick == 1 and depth:
            return [self.rng.choice(["lower", "abs", "coalesce"]), "(", *self.value(depth - 1), *self.rng.choice([[], [",", "0"]]), ")"]
        if pick == 2 and depth:
            return ["CAST", "(", *self.value(depth - 1), "AS", "STRING", ")"]
        return [self.name()] if pick < 4 else [str(self.rng.randint(0, 99))]

    def condition(self, depth: int = 3) -> list[str]:
        pick = self.rng.randrange(7) if depth else self.rng.randrange(4)
        if pick == 0:
            return [*self.value(depth), "IN", "(", *self.value(0), ",", *self.value(0), ")"]
        if pick == 1:
            return [self.name(), "IS", "NOT", "NULL"]
        if pick == 2:
            return [self.name(), "BETWEEN", *self.value(0), "AND", *self.value(0)]
        if pick == 3:
            return [*self.value(depth), self.rng.choice(["=", "<", ">=", "<>", "LIKE"]), *self.value(0)]
        if pick == 4:
            return ["NOT", "(", *self.condition(depth - 1), ")"]
        return ["(", *self.condition(depth - 1), ")", self.rng.choice(["AND", "or"]), *self.condition(depth - 1)]


@pytest.fixture(scope="module")
def parsed(spark):
    """Spark's own parser: the text of the condition tree, or None if the text is none."""
    parser = spark._jsparkSession.sessionState().sqlParser()

    def tree(condition: str) -> str | None:
        try:
            return parser.parseExpression(condition).toString()
        except Exception:
            return None

    return tree


def test_conditions_of_the_grammar_pass(parsed):
    for seed in range(150):
        clause = " ".join(Clauses(seed).condition())
        assert parsed(clause), clause
        assert check_where(clause) == clause


def test_damaged_conditions_are_refused():
    """One thing too many in code, never in quotes: a separator, a comment, a parenthesis, a quote, a raw literal, a statement word."""
    damages = [(";", "Several"), ("--", "Comments"), ("/*", "Comments"), ("(", "Unbalanced|plain|Function"), (")", "Unbalanced|plain"), ("'", "Unterminated|Several|Comments|Unbalanced|Keyword|plain|Function|Raw"),
               ("r'x'", "Raw"), ('R"x"', "Raw"), *((w.lower(), "Keyword") for w in FORBIDDEN_WORDS)]
    for seed, (damage, reason) in enumerate(damages * 6):
        clauses = Clauses(1000 + seed)
        tokens = clauses.condition()
        tokens.insert(clauses.rng.randint(0, len(tokens)), damage)
        with pytest.raises(ValueError, match=reason):
            check_where(" ".join(tokens))


def test_what_passes_stays_inside_its_parentheses(parsed):
    """Any mix of tokens: if the guard lets it pass, either Spark's parser refuses it or it is one operand of the condition around it."""
    soup = ["speed", "kind", "=", "1", "'a'", "''", "\"b\"", "`c`", "(", ")", "AND", "OR", "NOT", "IN", ",", ">", "'", "\\", "lower(kind)", "\n", "IS NULL", "e", "||"]
    passed = 0
    for seed in range(4000):
        rng = random.Random(seed)
        clause = rng.choice(["", " "]).join(rng.choices(soup, k=rng.randint(1, 9)))
        try:
            check_where(clause)
        except ValueError:
            continue
        alone, around = parsed(clause), parsed(f"({clause}) AND 7 = 8")
        passed += alone is not None
        assert around is None or around.endswith(" AND (7 = 8))"), clause
    assert passed > 40


@pytest.mark.parametrize("word", "DROP DELETE TRUNCATE ALTER CREATE INSERT UPDATE GRANT REVOKE EXEC EXECUTE MERGE UNION SELECT INTO".split())
def test_every_forbidden_word(word):
    with pytest.raises(ValueError):
        check_where(f"a = 1 {word.lower()} b")
    assert check_where(f"{word}_x = '{word}'")


def test_names():
    assert check_field(" a_1 ") == "a_1" and check_field("*") == "*" and check_identifier("geom") == "geom"
    for bad in ("a-b", "a b", "a;", ""):
        with pytest.raises(ValueError):
            check_field(bad)
        with pytest.raises(ValueError):
            check_identifier(bad)
    with pytest.raises(ValueError):
        check_identifier("*")


def test_ids():
    assert parse_ids("1, 2,,abc,1.5,3.0,9007199254740991,9007199254740993,-4") == [-4, 1, 2, 3, 9007199254740991]
    assert parse_ids(" , x") == []
    assert [parse_integer(v) for v in ("12", " 7x", None, "x", 3.9)] == [12, 7, 0, 0, 3]


def test_instants():
    assert [parse_instant(t) for t in ("0", " 1704067200000 ", "null", "NULL", "", "1.9", "-1e3")] == [0, 1704067200000, None, None, None, 1, -1000]
    for bad in ("abc", "1 2", "Infinity", "NaN", "1e30", "9e15"):
        with pytest.raises(ValueError):
            parse_instant(bad)


def test_request_parameters():
    q = FeatureQuery.from_params({
        "where": "a=1", "objectIds": "1,2", "inSR": "4326", "spatialRel": "x", "returnGeometry": "False", "returnCountOnly": "true",
        "resultOffset": "5", "resultRecordCount": "7x", "orderByFields": "a", "resultType": "tile", "f": "json", "token": "t", "time": ""})
    assert (q.where, q.object_ids, q.in_sr, q.spatial_rel, q.return_geometry, q.return_count_only) == ("a=1", "1,2", "4326", "x", False, True)
    assert (q.result_offset, q.result_record_count, q.time, q.tile) == (5, 7, None, False)
    assert FeatureQuery(result_type="Tile").tile


@pytest.mark.parametrize("clause", [
    "`reflect`('java.lang.System', 'getProperty', 'java.version') <> 'x'", "`java_method` ('a', 'b') = 'x'",
    "IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'java.version') <> 'x'", "identifier ('ref' || 'lect')('a') = 'b'"])
def test_function_names_stand_plainly(clause):
    with pytest.raises(ValueError, match="plain function names"):
        check_where(clause)
    assert check_where("`category` = 'identifier(' AND (`a` > 1)")


@pytest.mark.parametrize("call", ["reflect('a', 'b')", "try_reflect ('a')", "java_method\n('a')", "uuid()", "rand()", "current_user()", "input_file_name()",
                                  "raise_error('x')", "read_files('/etc')", "sum(speed)", "my_function(1)", "exists(list, x -> true)"])
def test_only_listed_functions(call):
    with pytest.raises(ValueError, match="Function"):
        check_where(f"kind = 'a' OR {call} = 1")


@pytest.mark.parametrize("clause", ["other.lower(kind) = 'a'", "cat . db . abs (1) = 1"])
def test_functions_of_other_schemas(clause):
    with pytest.raises(ValueError, match="plain function names"):
        check_where(clause)


def test_listed_functions_are_built_in(spark):
    """Every listed name is Spark's own, gives the same answer each time, and looks at one row."""
    known = {r.function.split(".")[-1] for r in spark.sql("SHOW SYSTEM FUNCTIONS").collect()}
    assert FUNCTIONS - known <= {"extract", "trim"}
    assert check_where("abs(speed) > 2 AND NOT (lower(kind) IN ('a') OR CAST(speed AS DECIMAL(9, 2)) BETWEEN (1) AND (2))")
