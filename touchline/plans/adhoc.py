"""Ad-hoc read-only SQL over the marts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from touchline.constants import ADHOC_ROW_LIMIT, ADHOC_TABLES, REFUSALS
from touchline.plans.textlog import audit_sql


class RefusedStatement(ValueError):
    """The statement failed the audit."""


#: What a statement may be made of, by the names that Spark's analysed plan gives to its operators ...
OPERATORS = frozenset("""
Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Join LateralJoin SubqueryAlias View Distinct Union Intersect Except Window Generate
WithCTE CTERelationDef CTERelationRef OneRowRelation LogicalRDD LocalRelation Expand Pivot ResolvedHint
""".split())
#: ... and to its expressions: columns and literals, logic, comparison, arithmetic, text, dates, aggregates, windows, subqueries.
EXPRESSIONS = frozenset("""
Alias AttributeReference OuterReference Literal TypedNullLiteral With CommonExpressionDef CommonExpressionRef Cast TryCast CaseWhen If Coalesce NullIf Nvl Nvl2 IsNull IsNotNull And Or Not EqualTo EqualNullSafe
LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual Between In InSubquery ScalarSubquery ListQuery Exists Like ILike RLike Contains StartsWith EndsWith
Add Subtract Multiply Divide IntegralDivide Remainder Pmod UnaryMinus UnaryPositive TryAdd TrySubtract TryMultiply TryDivide Abs Sign Sqrt Pow Exp Log
Round BRound Floor Ceil RoundFloor RoundCeil CeilExpressionBuilder Greatest Least Upper Lower InitCap Length Substring Left Right StringTrim StringTrimLeft
StringTrimRight StringTrimBoth StringReplace RegExpReplace RegExpExtract StringLocate StringInstr Concat ConcatWs StringSplit SplitPart StringLPad StringRPad
Reverse Year Quarter Month WeekOfYear DayOfMonth DayOfWeek DayOfYear WeekDay Hour Minute Second DatePart Extract TruncDate TruncTimestamp DateAdd DateSub
DateDiff DateAddInterval DateAddYMInterval TimeAdd TimestampAddYMInterval TimestampAddInterval TimestampAdd TimestampDiff SubtractDates SubtractTimestamps AddMonths MonthsBetween LastDay
DateFormatClass MakeDate MakeTimestamp ParseToDate ParseToTimestamp CurrentDate CurrentTimestamp Now LocalTimestamp UnixTimestamp
AggregateExpression Count CountIf Sum Average Min Max MinBy MaxBy First Last AnyValue Median Mode Percentile PercentileCont ApproximatePercentile StddevSamp StddevPop
VarianceSamp VariancePop Corr BoolAnd BoolOr CollectList CollectSet ListAgg GroupingID Grouping
WindowExpression WindowSpecDefinition SpecifiedWindowFrame UnboundedPreceding$ UnboundedFollowing$ CurrentRow$ RowNumber Rank DenseRank PercentRank CumeDist
NTile Lag Lead NthValue SortOrder CreateArray ArrayContains Size ElementAt GetArrayItem GetStructField SortArray ArrayJoin Explode PosExplode
""".split())
_SUBQUERIES = frozenset({"ScalarSubquery", "ListQuery", "Exists", "LateralSubquery"})
_QUOTED = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/""", re.S)
_MART = re.compile(r"(?i)\bgold\.(\w+)\b(?!\s*\()")


def _bound(sql: str) -> str:
    """The statement with every mart outside quotes and comments as a placeholder for a DataFrame."""
    escaped = sql.replace("{", "{{").replace("}", "}}")
    pieces, at = [], 0
    for quoted in [*_QUOTED.finditer(escaped), None]:
        end = quoted.start() if quoted else len(escaped)
        pieces.append(_MART.sub(lambda m: "{gold_" + m.group(1).lower() + "}", escaped[at:end]))
        if quoted:
            pieces.append(quoted.group())
            at = quoted.end()
    return "".join(pieces)


def _items(seq) -> Iterator:
    return (seq.apply(k) for k in range(seq.size()))


def _parts(plan) -> Iterator[tuple[str, object]]:
    """Every operator and expression of an analysed plan, those of its subqueries included."""
    plans, expressions = [plan], []
    while plans or expressions:
        if plans:
            node = plans.pop()
            yield "operator", node
            plans += [*_items(node.children()), *_items(node.innerChildren())]
            expressions += _items(node.expressions())
        else:
            node = expressions.pop()
            yield "expression", node
            expressions += _items(node.children())
            if node.getClass().getSimpleName() in _SUBQUERIES:
                plans.append(node.plan())


def _own_names(spark: SparkSession, sql: str) -> set[str]:
    """The names that the statement itself defines."""
    tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).treeString()
    return {n.strip().lower() for names in re.findall(r"(?:CTE|UnresolvedWith) \[([^\]\n]*)\]", tree) for n in names.split(",") if n.strip()}


def check_plan(spark: SparkSession, schemas: dict[str, StructType], bound: str) -> None:
    """Analyse the statement in a session of its own that knows empty marts only, and walk the plan.

    Nothing is executed. Columns of the empty marts carry a mark made for this call: a leaf without it is another relation,
    however it was named. Operators and expressions must be on the lists above.
    """
    alone, mark = spark.newSession(), uuid.uuid4().hex
    empty = {
        name: alone.createDataFrame([], StructType([StructField(f.name, f.dataType, True, {"mart": mark}) for f in schema]))
        for name, schema in schemas.items()
    }
    try:
        plan = alone.sql(bound, **empty)._jdf.queryExecution().analyzed()
    except ParseException as error:
        raise RefusedStatement("the statement cannot be parsed") from error
    except AnalysisException as error:
        raise RefusedStatement(f"the statement does not fit the marts: {error.getCondition()}") from error
    except KeyError as error:
        raise RefusedStatement(REFUSALS["unknown"] + str(error).strip("'").removeprefix("gold_")) from error
    for kind, node in _parts(plan):
        name = node.getClass().getSimpleName()
        if name not in (OPERATORS if kind == "operator" else EXPRESSIONS):
            raise RefusedStatement(f"{kind} not allowed: {name}")
        if kind == "operator" and not node.children().size() and name not in ("OneRowRelation", "CTERelationRef"):
            marks = [a.metadata().contains("mart") and a.metadata().getString("mart") == mark for a in _items(node.output())]
            if not marks or not all(marks):
                raise RefusedStatement(REFUSALS["unknown"] + name)


def run_readonly(spark: SparkSession, marts: dict[str, DataFrame], statement: str) -> DataFrame:
    """Audit one statement and run it over the allow-listed marts, at most 100 rows.

    The text is audited first; then Spark analyses the statement over empty marts, and whatever the plan reads must be one of
    them and whatever it computes must be on a list of allowed operators and expressions (``check_plan``). Files, the catalog,
    views of the session, scripts and reflection are so out of reach. A name that the statement defines must not be that of a
    view or table of the session.
    """
    one = spark.createDataFrame([(statement,)], "statement string")
    verdict = audit_sql(one, "statement").first()
    if verdict["verdict"] != "ok":
        raise RefusedStatement(verdict["verdict"])
    args = {f"gold_{t}": marts[t] for t in ADHOC_TABLES if t in marts}
    bound = _bound(verdict["safe_sql"])
    check_plan(spark, {name: df.schema for name, df in args.items()}, bound)
    taken = sorted(n for n in _own_names(spark, verdict["safe_sql"]) if spark.catalog.tableExists(n))
    if taken:
        raise RefusedStatement(REFUSALS["unknown"] + ", ".join(taken))
    return spark.sql(bound, **args).limit(ADHOC_ROW_LIMIT)
