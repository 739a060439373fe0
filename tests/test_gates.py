"""Gates, each on queries that pass and that don't."""

from tidemark.operators import gates as g

T = g.Table("events", {"value": g.NONADDITIVE, "user_id": g.IDENTIFIER, "at": g.EPOCH, "kind_no": g.CATEGORY, "bytes": g.ADDITIVE},
            [("nullable_metric", "bytes"), ("exclude_flag", "is_test"), ("exact_distinct", "user_id")], [{"term": "heavy user", "column": "bytes", "numbers": [100], "shape": "threshold"}])


def test_style():
    assert g.g0_style('SELECT TIME_FLOOR(__time, \'P1D\') AS "d", COUNT(*) AS "n" FROM t GROUP BY 1 ORDER BY 2 DESC') == []
    assert g.g0_style('SELECT a, ROW_NUMBER() OVER (PARTITION BY a ORDER BY b) AS "r", CAST(b AS BIGINT) AS "c" FROM t') == []
    assert g.g0_style("SELECT a AS x FROM t GROUP BY a;") == ["GROUP BY must use ordinals", "alias 'x' is not quoted", "trailing semicolon"]
    assert g.g0_style("```SELECT 1```") and g.g0_style("SELECT 1; SELECT 2")


def test_literals():
    assert g.g3_literals("errors for 'web' pages", "SELECT 1 FROM t WHERE a = 'web'") == []
    assert g.g3_literals("page views", "SELECT 1 FROM t WHERE a = 'page_view' AND b <> 'none'") == []
    assert g.g3_literals("declined orders", "SELECT 1 FROM t WHERE a = 'approved'", known="declined, approved", value_lists=[["declined", "approved"]])
    assert g.g3_literals("all orders", "SELECT 1 FROM t WHERE a = 'secret'") and g.g3_literals("only 'x'", "SELECT 1 FROM t")


def test_roles():
    bad = lambda s, **k: bool(g.g5_roles(f"SELECT {s} FROM events", [T], **k))
    assert bad("SUM(value)") and not bad("SUM(value)", total_asked=True) and not bad("AVG(value)") and not bad("SUM(bytes)")
    assert bad("MAX(user_id)") and not bad("COUNT(DISTINCT user_id)") and bad("AVG(at)") and not bad("MAX(at)") and bad("AVG(kind_no)")


def test_instructions():
    ok = "SELECT SUM(bytes) FROM events WHERE bytes IS NOT NULL AND is_test = 0"
    assert g.g6_instructions("total", ok, [T]) == []
    assert len(g.g6_instructions("heavy users", "SELECT SUM(bytes), APPROX_COUNT_DISTINCT(user_id) FROM events", [T])) == 4
    assert g.g6_instructions("heavy users", ok + " AND bytes > 100", [T]) == []


def test_phrases_styles_units():
    assert g.g8_phrases("orders yesterday", "SELECT 1") and not g.g8_phrases("orders", "SELECT 1")
    assert g.g7_style_truth("show the revenue", ["revenue"], "business") and not g.g7_style_truth("show the revenue", ["revenue"], "exact_column")
    assert g.g10_epoch_unit("SELECT MILLIS_TO_TIMESTAMP(at * 1000) FROM events", "columns: at BIGINT", [T])
    assert not g.g10_epoch_unit("SELECT MILLIS_TO_TIMESTAMP(at * 1000) FROM events", "columns: at BIGINT, epoch seconds", [T])
    assert g.g10_epoch_unit("SELECT AVG((at - start_at) / 60.0) FROM events", "", [T]) and not g.g10_epoch_unit("SELECT MAX(at) FROM events", "", [T])
