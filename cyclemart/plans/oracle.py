"""DuckDB SQL for each registered query, written from the rules and not from the Spark plans.

Shared steps are named CTEs; ``_sql`` puts in those a query mentions, in order.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    "linhas": """
        SELECT o_orderkey AS nunota, CAST(n_regionkey + 1 AS BIGINT) AS codemp, l_suppkey + 1 AS codvend,
               o_custkey + 1 AS codparc, l_partkey + 1 AS codprod,
               CAST(l_quantity AS DECIMAL(15,2)) AS qtdneg,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS vlrtot,
               CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)) AS vlrdesc,
               CAST(p_retailprice AS DECIMAL(15,2)) AS vlrcus,
               CASE WHEN o_orderstatus = 'P' THEN 'C' WHEN l_returnflag = 'R' THEN 'D' ELSE 'V' END AS tipo,
               CAST(CASE WHEN o_orderstatus <> 'P' AND l_returnflag = 'R' THEN l_shipdate ELSE o_orderdate END AS DATE) AS data_ref
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey""",
    "vendas": """
        SELECT data_ref, codemp, codvend, SUM(vlrtot - ROUND(vlrdesc, 2)) AS vlr_nota,
               SUM(vlrcus * qtdneg - (vlrtot - ROUND(vlrdesc, 2))) AS vlr_desconto,
               COUNT(DISTINCT nunota) AS qtd_transacoes
        FROM linhas WHERE tipo = 'V' GROUP BY ALL""",
    "devolucoes": """
        SELECT data_ref, codemp, codvend, SUM(vlrtot - vlrdesc) AS vlr_devolucao
        FROM linhas WHERE tipo = 'D' GROUP BY ALL""",
    "canceladas": """
        SELECT data_ref, codemp, codvend, SUM(vlrtot - vlrdesc) AS vlr_cancelada
        FROM linhas WHERE tipo = 'C' GROUP BY ALL""",
    "ciclos": """
        SELECT CAST(m AS DATE) AS dtref, CAST(m - INTERVAL 1 MONTH + INTERVAL 25 DAY AS DATE) AS dtinic,
               CAST(m + INTERVAL 24 DAY AS DATE) AS dtfin
        FROM (SELECT UNNEST(generate_series(DATE_TRUNC('month', CAST(MIN(d) AS DATE) - INTERVAL 25 DAY + INTERVAL 1 MONTH),
                                            DATE_TRUNC('month', CAST(MAX(d) AS DATE) - INTERVAL 25 DAY + INTERVAL 1 MONTH),
                                            INTERVAL 1 MONTH)) AS m
              FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem))""",
    "dias": """
        SELECT dtref, dtinic, dtfin, CAST(d AS DATE) AS dia,
               isodow(d) < 7 AND CAST(d AS DATE) NOT IN (DATE '1997-12-25', DATE '1998-01-01', DATE '1998-02-24') AS util
        FROM (SELECT *, UNNEST(generate_series(CAST(dtinic AS TIMESTAMP), CAST(dtfin AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM ciclos)""",
    "uteis": """
        SELECT dtref, dtinic, dtfin, CAST(COUNT(*) FILTER (WHERE util) AS BIGINT) AS dias_uteis
        FROM dias GROUP BY ALL""",
    "metas": """
        SELECT dtref, s_suppkey + 1 AS codvend,
               CAST(100000 + (((s_suppkey + 1) * 7 + month(dtref) * 3) % 11) * 20000 AS DECIMAL(15,2)) AS meta_mensal,
               CAST(CAST(100 + ((s_suppkey + 1) % 4) * 25 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2)) AS perc
        FROM supplier, ciclos""",
    "metas_dia": """
        SELECT dia AS data_ref, codvend, meta_mensal, perc, dias_uteis, util,
               CASE WHEN util AND meta_mensal > 0 THEN CAST(meta_mensal AS DOUBLE) / GREATEST(dias_uteis, 1) ELSE 0.0 END AS meta_diaria
        FROM dias JOIN uteis USING (dtref) JOIN metas USING (dtref)""",
    "sementes": """
        SELECT data_ref, codemp, codvend FROM vendas UNION SELECT data_ref, codemp, codvend FROM devolucoes
        UNION SELECT data_ref, codemp, codvend FROM canceladas UNION SELECT data_ref, 0, codvend FROM metas_dia""",
    "juntos": """
        SELECT s.data_ref, s.codemp, s.codvend, COALESCE(vlr_nota, 0) AS nota, COALESCE(vlr_devolucao, 0) AS devolucao,
               COALESCE(vlr_cancelada, 0) AS cancelada, COALESCE(vlr_desconto, 0) AS desconto,
               COALESCE(qtd_transacoes, 0) AS qtd, COALESCE(p.perc, 0) AS perc, COALESCE(m.meta_mensal, 0) AS meta_mensal,
               COALESCE(m.meta_diaria, 0) AS meta_diaria,
               GREATEST(COALESCE(vlr_nota, 0) - COALESCE(vlr_devolucao, 0), 0) AS liquido
        FROM sementes s LEFT JOIN vendas USING (data_ref, codemp, codvend)
        LEFT JOIN devolucoes USING (data_ref, codemp, codvend) LEFT JOIN canceladas USING (data_ref, codemp, codvend)
        LEFT JOIN metas_dia p ON p.data_ref = s.data_ref AND p.codvend = s.codvend
        LEFT JOIN metas_dia m ON m.data_ref = s.data_ref AND m.codvend = s.codvend AND s.codemp = 0""",
    "fato": """
        SELECT data_ref AS id_tempo, codvend AS id_vendedor, codemp AS id_empresa,
               CAST(meta_diaria AS DECIMAL(15,2)) AS valor_meta_diaria, CAST(meta_mensal AS DECIMAL(15,2)) AS valor_meta_mensal,
               CAST(liquido AS DECIMAL(15,2)) AS valor_realizado, CAST(devolucao AS DECIMAL(15,2)) AS valor_devolucao,
               CAST(cancelada AS DECIMAL(15,2)) AS valor_cancelado,
               CAST(CAST(liquido AS DECIMAL(18,4)) * CAST(perc AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS valor_comissao,
               CAST(desconto AS DECIMAL(15,2)) AS valor_desconto, CAST(qtd AS BIGINT) AS qtd_transacoes
        FROM juntos""",
    "vendedores": "SELECT s_suppkey + 1 AS id_vendedor, s_name AS nome_comercial FROM supplier",
    "produtos": """
        SELECT p_partkey + 1 AS codprod, p_name || ' ' || (p_partkey + 1) AS nome, p_name AS nome_simples,
               CASE WHEN p_size % 25 = 0 THEN 0 ELSE CAST(SUBSTR(p_brand, 7) AS BIGINT) END AS codmarca,
               CASE WHEN p_size % 25 = 0 THEN 'SEM MARCA' ELSE p_brand END AS marca,
               p_type AS refforn, 'size ' || p_size AS complemento FROM part""",
    # rankings
    "itens": """
        SELECT DATE_TRUNC('month', data_ref) AS mes, codemp, codvend, 'CLIENTE' AS tipo, codparc AS id_item, c_name AS label_item,
               vlrtot - vlrdesc AS valor FROM linhas JOIN customer ON c_custkey + 1 = codparc WHERE tipo = 'V'
        UNION ALL
        SELECT DATE_TRUNC('month', data_ref), codemp, codvend, 'MARCA', codmarca, marca, vlrtot - vlrdesc
        FROM linhas JOIN produtos USING (codprod) WHERE linhas.tipo = 'V'
        UNION ALL
        SELECT DATE_TRUNC('month', data_ref), codemp, codvend, 'PRODUTO', codprod, nome, vlrtot - vlrdesc
        FROM linhas JOIN produtos USING (codprod) WHERE linhas.tipo = 'V'""",
    "somas": """
        SELECT mes, tipo, codemp, codvend, id_item, label_item, SUM(valor) AS total,
               GROUPING(codemp) * 2 + GROUPING(codvend) AS nivel
        FROM itens GROUP BY GROUPING SETS (
            (mes, tipo, codemp, codvend, id_item, label_item), (mes, tipo, codvend, id_item, label_item),
            (mes, tipo, codemp, id_item, label_item), (mes, tipo, id_item, label_item))""",
    "posicoes": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY mes, tipo, nivel, codemp, codvend ORDER BY total DESC, id_item) AS posicao
        FROM somas""",
    "ranks": """
        SELECT CAST(mes AS DATE) AS dtref, tipo, CAST(nivel AS BIGINT) AS nivel, CASE WHEN nivel IN (2, 3) THEN 0 ELSE codemp END AS id_empresa,
               CASE WHEN nivel IN (1, 3) THEN 0 ELSE codvend END AS id_vendedor, posicao, id_item, label_item,
               CAST(total AS DECIMAL(15,2)) AS valor
        FROM posicoes WHERE posicao <= 10""",
    "multi": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY dtref, tipo ORDER BY valor DESC, id_item) AS posicao FROM (
            SELECT dtref, tipo, id_item, label_item, SUM(valor) AS valor FROM ranks
            WHERE nivel = 1 AND id_empresa IN (1, 2) GROUP BY ALL) QUALIFY posicao <= 10""",
    "listas": "SELECT * FROM posicoes WHERE nivel = 1 AND codemp IN (1, 2) AND posicao <= 50",
    "cortes": """
        SELECT mes, tipo, codemp, CAST(COUNT(*) = 50 AS INT) AS cheia,
               CASE WHEN COUNT(*) = 50 THEN GREATEST(MIN(total), 0) ELSE 0 END AS corte FROM listas GROUP BY ALL""",
    "limites": """
        SELECT mes, tipo, id_item, SUM(total) AS total, SUM(corte) AS proprio, SUM(cheia) AS em
        FROM listas JOIN cortes USING (mes, tipo, codemp) GROUP BY ALL""",
    "tetos": "SELECT mes, tipo, SUM(corte) AS teto, SUM(cheia) AS cheias FROM cortes GROUP BY ALL",
    "ultimos": """
        SELECT mes, tipo, total AS ultimo FROM limites JOIN tetos USING (mes, tipo) WHERE em = cheias
        QUALIFY ROW_NUMBER() OVER (PARTITION BY mes, tipo ORDER BY total DESC, id_item) = 10""",
    "abertos": """
        SELECT mes, tipo FROM limites JOIN tetos USING (mes, tipo) LEFT JOIN ultimos USING (mes, tipo) WHERE cheias > 0
        GROUP BY mes, tipo, teto, ultimo
        HAVING ultimo IS NULL OR teto >= ultimo OR MAX(CASE WHEN em < cheias THEN total + teto - proprio END) >= ultimo""",
    # profiles
    "clientes_mes": "SELECT DISTINCT dtref, id_item AS codparc FROM ranks WHERE tipo = 'CLIENTE' AND id_item > 0",
    "compras": """
        SELECT c.dtref, l.codparc, l.codemp, l.codvend, s_name AS vendedor, l.codprod, l.data_ref,
               SUM(vlrtot - vlrdesc) AS valor
        FROM linhas l JOIN clientes_mes c ON c.codparc = l.codparc
             AND l.data_ref BETWEEN LAST_DAY(c.dtref) - 180 AND LAST_DAY(c.dtref)
        JOIN supplier ON s_suppkey + 1 = l.codvend WHERE tipo = 'V' GROUP BY ALL""",
    "compras_nivel": """
        SELECT 3 AS nivel, dtref, codparc, 0 AS emp, 0 AS vend, vendedor, codprod, data_ref, valor FROM compras
        UNION ALL SELECT 1, dtref, codparc, codemp, 0, vendedor, codprod, data_ref, valor FROM compras
        UNION ALL SELECT 2, dtref, codparc, 0, codvend, vendedor, codprod, data_ref, valor FROM compras
        UNION ALL SELECT 0, dtref, codparc, codemp, codvend, vendedor, codprod, data_ref, valor FROM compras""",
    "intervalos": """
        SELECT nivel, dtref, codparc, emp, vend, AVG(gap) AS medio FROM (
            SELECT nivel, dtref, codparc, emp, vend,
                   data_ref - LAG(data_ref) OVER (PARTITION BY nivel, dtref, codparc, emp, vend ORDER BY data_ref) AS gap
            FROM (SELECT DISTINCT nivel, dtref, codparc, emp, vend, data_ref FROM compras_nivel)) GROUP BY ALL""",
    "perfil_produtos": """
        SELECT nivel, dtref, codparc, emp, vend, codprod, SUM(valor) AS total,
               ROW_NUMBER() OVER (PARTITION BY nivel, dtref, codparc, emp, vend ORDER BY SUM(valor) DESC, codprod) AS posicao
        FROM compras_nivel GROUP BY nivel, dtref, codparc, emp, vend, codprod QUALIFY posicao <= 5""",
    "perfil_vendedores": """
        SELECT nivel, dtref, codparc, emp, vend, vendedor, SUM(valor) AS total,
               ROW_NUMBER() OVER (PARTITION BY nivel, dtref, codparc, emp, vend ORDER BY SUM(valor) DESC, vendedor) AS posicao
        FROM compras_nivel GROUP BY nivel, dtref, codparc, emp, vend, vendedor QUALIFY posicao <= 3""",
    "marcas_mes": "SELECT DISTINCT dtref, id_item AS codmarca FROM ranks WHERE tipo = 'MARCA'",
    "marca_nivel": """
        SELECT UNNEST([0, 1, 2, 3]) AS nivel, CAST(DATE_TRUNC('month', data_ref) AS DATE) AS dtref, codmarca, codemp, codvend,
               codprod, vlrtot - vlrdesc AS valor
        FROM linhas JOIN produtos USING (codprod) WHERE tipo = 'V'""",
    "marca_produtos": """
        SELECT nivel, dtref, codmarca, IF(nivel IN (2, 3), 0, codemp) AS emp, IF(nivel IN (1, 3), 0, codvend) AS vend, codprod,
               SUM(valor) AS total
        FROM marca_nivel JOIN marcas_mes USING (dtref, codmarca) GROUP BY ALL""",
    "perfil_marcas": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY nivel, dtref, codmarca, emp, vend ORDER BY total DESC, codprod) AS posicao
        FROM marca_produtos QUALIFY posicao <= 5""",
    # kpis
    "fato_ciclo": "SELECT dtref, fato.* FROM fato JOIN dias ON dia = id_tempo",
    "taxas": """
        SELECT id_vendedor, id_tempo, id_empresa,
               CAST(CAST(valor_comissao AS DOUBLE) / CAST(valor_realizado AS DOUBLE) AS DECIMAL(18,10)) AS taxa
        FROM fato WHERE id_tempo >= DATE '1998-01-01' AND valor_comissao > 0 AND valor_realizado > 0
        QUALIFY ROW_NUMBER() OVER (PARTITION BY id_vendedor ORDER BY id_tempo DESC, id_empresa) = 1""",
}

MOVED = "(valor_realizado <> 0 OR valor_devolucao <> 0 OR valor_meta_diaria <> 0)"


def _request(actual: str = "id_empresa > 0", sellers: str = "", resolve: bool = False) -> dict[str, str]:
    """CTEs for one KPI request. ``resolve`` limits it to sellers active in the company."""
    limit = f"AND id_vendedor IN ({sellers})" if sellers else ""
    ativos = ""
    if resolve:
        ativos = "SEMI JOIN (SELECT DISTINCT dtref, id_vendedor FROM fato_ciclo JOIN vendedores USING (id_vendedor) " \
                 f"WHERE {MOVED} AND {actual}) USING (dtref, id_vendedor)"
    return {
        "reais": f"SELECT * FROM fato_ciclo {ativos} WHERE {actual} {limit}",
        "alvos": f"SELECT * FROM fato_ciclo {ativos} WHERE id_empresa = 0 {limit}",
        "serie": """
            SELECT dtref, date, SUM(r) AS realized, SUM(m) AS meta FROM (
                SELECT dtref, id_tempo AS date, SUM(valor_realizado) AS r, 0 AS m FROM reais GROUP BY ALL
                UNION ALL SELECT dtref, id_tempo, 0, SUM(valor_meta_diaria) FROM alvos GROUP BY ALL) GROUP BY ALL""",
        "por_vendedor": """
            SELECT dtref, id_vendedor, SUM(valor_realizado) AS v_realizado, SUM(valor_devolucao) AS v_devolucao,
                   SUM(valor_cancelado) AS v_cancelado, SUM(valor_desconto) AS v_desconto,
                   CAST(SUM(qtd_transacoes) AS BIGINT) AS v_tkts, COUNT(*) AS linhas
            FROM reais GROUP BY ALL""",
        "meta_vend": "SELECT dtref, id_vendedor, MAX(valor_meta_mensal) AS meta_vendedor FROM alvos GROUP BY ALL",
        "metas_ciclo": "SELECT dtref, SUM(meta_vendedor) AS meta FROM meta_vend GROUP BY ALL",
        "somas_ciclo": """
            SELECT dtref, SUM(v_realizado) AS realizado, SUM(v_devolucao) AS devolucao, SUM(v_cancelado) AS cancelado,
                   CAST(SUM(CAST(v_realizado AS DECIMAL(18,2)) * COALESCE(taxa, CAST(0.01 AS DECIMAL(18,10)))) AS DECIMAL(24,2)) AS comissao,
                   SUM(v_desconto) AS desconto, SUM(v_tkts) AS tkts
            FROM por_vendedor LEFT JOIN taxas USING (id_vendedor) GROUP BY ALL""",
        "cartoes": """
            SELECT dtref, COALESCE(meta, 0) AS meta, COALESCE(realizado, 0) AS realizado, COALESCE(devolucao, 0) AS devolucao,
                   COALESCE(cancelado, 0) AS cancelado, COALESCE(comissao, 0) AS comissao, COALESCE(desconto, 0) AS desconto,
                   CAST(COALESCE(tkts, 0) AS BIGINT) AS tkts,
                   CASE WHEN tkts > 0 THEN CAST(realizado AS DOUBLE) / CAST(tkts AS DOUBLE) ELSE 0.0 END AS ticket_medio
            FROM ciclos LEFT JOIN metas_ciclo USING (dtref) LEFT JOIN somas_ciclo USING (dtref)""",
        "nomes": """
            SELECT dtref, nome_comercial AS name, SUM(valor_realizado) AS realized
            FROM reais JOIN vendedores USING (id_vendedor) GROUP BY ALL""",
        "derivados": """
            SELECT c.*, GREATEST(COALESCE(n, 0), 1) AS dias_com_venda, dias_uteis, CAST(realizado AS DOUBLE) AS r,
                   CAST(meta AS DOUBLE) AS m, CAST(desconto AS DOUBLE) AS d, CAST(devolucao + cancelado AS DOUBLE) AS p
            FROM cartoes c JOIN uteis USING (dtref)
            LEFT JOIN (SELECT dtref, COUNT(*) AS n FROM serie WHERE realized > 0 GROUP BY ALL) USING (dtref)""",
        "calculados": """
            SELECT *, CASE WHEN m > 0 THEN r / m ELSE 0.0 END AS atingimento, p AS total_perdido,
                   CASE WHEN r + p > 0 THEN p / (r + p) * 100 ELSE 0.0 END AS perc_perdido,
                   CASE WHEN r + d > 0 THEN d / (r + d) * 100 ELSE 0.0 END AS perc_desconto,
                   CASE WHEN tkts > 0 THEN d / CAST(tkts AS DOUBLE) ELSE 0.0 END AS desconto_medio,
                   r / dias_com_venda * dias_uteis AS projetado, r / dias_com_venda AS media_diaria,
                   GREATEST(meta - realizado, 0) AS restante
            FROM derivados""",
        "faixas": f"""
            SELECT *, CASE WHEN m > 0 THEN projetado / m * 100 ELSE 0.0 END AS perc_projetado, {_tier("atingimento")} AS taxa_total
            FROM calculados""",
        "finais": """
            SELECT *, CAST(GREATEST(ROUND(CAST(realizado AS DECIMAL(18,2)) * taxa_total
                      - CAST(realizado AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(6,4)), 2), 0) AS DECIMAL(18,2)) AS premio
            FROM faixas""",
    }


def _tier(value: str) -> str:
    steps = (("1.5", "0.0150"), ("1.4", "0.0140"), ("1.3", "0.0130"), ("1.2", "0.0120"), ("1.1", "0.0110"), ("1.0", "0.0105"))
    cases = " ".join(f"WHEN {value} >= CAST({floor} AS DOUBLE) THEN CAST({rate} AS DECIMAL(6,4))" for floor, rate in steps)
    return f"CASE {cases} ELSE CAST(0.0100 AS DECIMAL(6,4)) END"


def _sql(select: str, extra: dict[str, str] | None = None) -> str:
    """Put in front of ``select`` the CTEs it needs, directly or through others."""
    known = {**CTES, **(extra or {})}
    needed: set[str] = set()
    todo = [select]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in known.keys() & words - needed:
            needed.add(name)
            todo.append(known[name])
    ctes = ",\n".join(f"{name} AS ({known[name]})" for name in known if name in needed)
    return f"WITH {ctes}\n{select}" if ctes else select


def _d(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _t(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def _brl(value: str) -> str:
    return f"'R$ ' || TRANSLATE(FORMAT('{{:,.2f}}', COALESCE(CAST({value} AS DOUBLE), 0.0)), ',.', '.,')"


def _comma(value: str, decimals: int) -> str:
    return f"TRANSLATE(FORMAT('{{:.{decimals}f}}', {value}), '.', ',')"


def _compact(value: str) -> str:
    v = f"CAST({value} AS DOUBLE)"
    return (f"CASE WHEN ABS({v}) >= 1e6 THEN 'R$ ' || {_comma(f'{v} / 1e6', 2)} || 'M' "
            f"WHEN ABS({v}) >= 1e3 THEN 'R$ ' || {_comma(f'{v} / 1e3', 1)} || 'K' ELSE {_brl(value)} END")


def _pct(value: str) -> str:
    return f"{_comma(value, 1)} || '%'"


def _tickets(value: str) -> str:
    return f"REPLACE(FORMAT('{{:,}}', CAST({value} AS BIGINT)), ',', '.') || ' transações'"


def _mean(total: str, count: str) -> str:
    """Half-up average in cents of a non-negative total with four decimals, by whole numbers."""
    units = f"CAST({total} * 10000 AS HUGEINT)"
    return f"CAST((2 * {units} + 100 * {count}) // (200 * {count}) AS DOUBLE) / 100"


FACT = f"""SELECT {_t("id_tempo")}, id_vendedor, id_empresa, {_d("valor_meta_diaria", "valor_meta_mensal", "valor_realizado",
    "valor_devolucao", "valor_cancelado", "valor_comissao", "valor_desconto")}, qtd_transacoes FROM fato"""
RANK = f"SELECT {_t('dtref')}, nivel, id_empresa, id_vendedor, posicao, id_item, label_item, {_d('valor')} FROM ranks"
CARDS = f"""SELECT {_t("dtref")}, {_d("meta", "realizado", "devolucao", "cancelado", "comissao", "desconto")}, tkts, ticket_medio
    FROM cartoes"""
DAILY = f"SELECT {_t('dtref', 'date')}, {_d('realized', 'meta')} FROM serie"
TOP = f"""SELECT {_t("dtref")}, name, {_d("realized")},
    ROW_NUMBER() OVER (PARTITION BY dtref ORDER BY realized DESC, name) AS posicao FROM nomes QUALIFY posicao <= 5"""
LOOKUP = """SELECT CAST(dtref AS VARCHAR) AS dtref, tipo, posicao, id_item, label_item, CAST(valor AS DOUBLE) AS valor,
    COALESCE(CASE WHEN tipo = 'PRODUTO' THEN refforn END, '') AS refforn,
    COALESCE(CASE WHEN tipo = 'PRODUTO' THEN complemento END, '') AS complemento
    FROM {rows} r LEFT JOIN produtos ON codprod = id_item AND tipo = 'PRODUTO'"""
CUSTOMER_KEYS = "CAST(dtref AS VARCHAR) AS dtref, CAST(nivel AS BIGINT) AS nivel, codparc AS id_cliente, emp AS id_empresa, vend AS id_vendedor"
CUSTOMER_ENTRIES = """SELECT nivel, dtref, codparc, emp, vend, 'PRODUTO' AS lista, posicao, nome, CAST(total AS DECIMAL(15,2)) AS valor, refforn, complemento
    FROM perfil_produtos JOIN produtos USING (codprod)
    UNION ALL SELECT nivel, dtref, codparc, emp, vend, 'VENDEDOR', posicao, vendedor, CAST(total AS DECIMAL(15,2)), '', '' FROM perfil_vendedores"""
ALL = _request()
COMPANY_1 = _request("id_empresa = 1", resolve=True)
COMPANIES_1_2 = _request("id_empresa IN (1, 2)", resolve=True)
COMPANIES_2_3 = _request("id_empresa IN (2, 3)", resolve=True)
NOTHING = _request("1 = 0", resolve=True)
REPORT = {"vendas_linha": """SELECT CAST(DATE_TRUNC('month', data_ref) AS DATE) AS mes, codvend AS id_vendedor, qtdneg, tipo,
    vlrtot - vlrdesc AS valor FROM linhas"""}

ORACLE: dict[str, str] = {
    "sales_daily": _sql(f"SELECT {_t('data_ref')}, codemp, codvend, {_d('vlr_nota', 'vlr_desconto')}, qtd_transacoes FROM vendas"),
    "returns_daily": _sql(f"SELECT {_t('data_ref')}, codemp, codvend, {_d('vlr_devolucao')} FROM devolucoes"),
    "cancels_daily": _sql(f"SELECT {_t('data_ref')}, codemp, codvend, {_d('vlr_cancelada')} FROM canceladas"),
    "movements_daily": _sql("""SELECT CAST(data_ref AS VARCHAR) AS data_ref, codemp, codvend,
        CAST(nota AS DOUBLE) AS vlr_nota, CAST(desconto AS DOUBLE) AS vlr_desconto, qtd AS qtd_transacoes,
        CAST(devolucao AS DOUBLE) AS vlr_devolucao, CAST(cancelada AS DOUBLE) AS vlr_cancelada FROM juntos WHERE codemp > 0"""),
    "goals_by_day": _sql("""SELECT CAST(data_ref AS VARCHAR) AS data_ref, codvend, CAST(meta_mensal AS DOUBLE) AS meta_mensal,
        CAST(perc AS DOUBLE) AS perc_comissao, dias_uteis, CAST(util AS BIGINT) AS dia_util, CAST(meta_diaria AS DOUBLE) AS meta_diaria
        FROM metas_dia"""),
    "working_days_by_cycle": _sql(f"SELECT {_t('dtref', 'dtinic', 'dtfin')}, dias_uteis FROM uteis"),
    "calendar_spine": _sql("SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(dia AS VARCHAR) AS date, CAST(util AS BIGINT) AS dia_util FROM dias"),
    "fact_daily": _sql(FACT),
    "fact_period": _sql(f"{FACT} WHERE id_tempo BETWEEN DATE '1998-02-26' AND DATE '1998-03-25'"),
    "dim_time": _sql("""SELECT DISTINCT CAST(id_tempo AS VARCHAR) AS id_tempo, year(id_tempo) AS ano, month(id_tempo) AS mes,
        day(id_tempo) AS dia, quarter(id_tempo) AS trimestre FROM fato"""),
    "dim_seller": _sql("SELECT id_vendedor, nome_comercial FROM vendedores"),
    "dim_company": """SELECT CAST(r_regionkey + 1 AS BIGINT) AS id_empresa, r_name AS nome FROM region
        UNION ALL SELECT 0, 'CORPORATIVO (METAS)'""",
    "dim_customer": "SELECT c_custkey + 1 AS id_parceiro, c_name AS nome_parceiro FROM customer",
    "dim_brand": _sql("SELECT DISTINCT codmarca AS id_marca, marca AS nome_marca FROM produtos"),
    "dim_product": _sql("SELECT codprod AS id_produto, nome AS nome_produto, refforn, complemento FROM produtos"),
    "dim_cycle": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(dtinic AS VARCHAR) AS dtinic, CAST(dtfin AS VARCHAR) AS dtfin,
        ['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', 'Outubro', 'Novembro',
         'Dezembro'][month(dtref)] || ' / ' || year(dtref) AS label FROM ciclos"""),
    "rank_customers": _sql(f"{RANK} WHERE tipo = 'CLIENTE'"),
    "rank_brands": _sql(f"{RANK} WHERE tipo = 'MARCA'"),
    "rank_products": _sql(f"{RANK} WHERE tipo = 'PRODUTO'"),
    "rankings_all": _sql(RANK.replace("SELECT", "SELECT tipo,", 1)),
    "rank_lookup": _sql(LOOKUP.format(rows="(SELECT * FROM ranks WHERE nivel = 1 AND id_empresa = 1)")),
    "rank_lookup_seller": _sql(LOOKUP.format(rows="""(SELECT * FROM ranks WHERE nivel = 0 AND id_empresa = 1 AND id_vendedor = 3
        AND dtref = DATE '1998-03-01')""")),
    "rank_multi_branch": _sql(LOOKUP.format(rows="multi")),
    "rank_multi_branch_exact": _sql("""SELECT CAST(CAST(mes AS DATE) AS VARCHAR) AS dtref, tipo, posicao, id_item, label_item,
        CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor FROM (
            SELECT mes, tipo, id_item, label_item, SUM(valor) AS total,
                   ROW_NUMBER() OVER (PARTITION BY mes, tipo ORDER BY SUM(valor) DESC, id_item) AS posicao
            FROM itens WHERE codemp IN (1, 2) GROUP BY mes, tipo, id_item, label_item QUALIFY posicao <= 10)"""),
    "rank_multi_branch_bounded": _sql("""SELECT CAST(CAST(mes AS DATE) AS VARCHAR) AS dtref, tipo, posicao, id_item, label_item,
        CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor,
        CAST((mes, tipo) IN (SELECT (mes, tipo) FROM abertos) AS BIGINT) AS recalculado,
        (SELECT COUNT(*) FROM abertos) AS grupos_recalculados FROM (
            SELECT mes, tipo, id_item, label_item, SUM(valor) AS total,
                   ROW_NUMBER() OVER (PARTITION BY mes, tipo ORDER BY SUM(valor) DESC, id_item) AS posicao
            FROM itens WHERE codemp IN (1, 2) GROUP BY mes, tipo, id_item, label_item QUALIFY posicao <= 10)"""),
    "rank_totals": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(nivel AS BIGINT) AS nivel, id_empresa, id_vendedor, tipo, CAST(SUM(valor) AS DOUBLE) AS total FROM ranks
        GROUP BY ALL"""),
    "customer_profile": _sql("""SELECT CAST(t.dtref AS VARCHAR) AS dtref, CAST(t.nivel AS BIGINT) AS nivel, t.codparc AS id_cliente,
        t.emp AS id_empresa, t.vend AS id_vendedor, COALESCE(CAST(medio AS DOUBLE), 0.0) AS tempo_medio_compra, lista, posicao, nome,
        CAST(valor AS DOUBLE) AS valor, refforn, complemento
        FROM (SELECT nivel, dtref, codparc, emp, vend, 'PRODUTO' AS lista, posicao, nome, CAST(total AS DECIMAL(15,2)) AS valor,
                     refforn, complemento FROM perfil_produtos JOIN produtos USING (codprod)
              UNION ALL SELECT nivel, dtref, codparc, emp, vend, 'VENDEDOR', posicao, vendedor, CAST(total AS DECIMAL(15,2)), '', ''
              FROM perfil_vendedores) t
        JOIN intervalos USING (nivel, dtref, codparc, emp, vend)"""),
    "repurchase_gap": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(nivel AS BIGINT) AS nivel, codparc AS id_cliente,
        emp AS id_empresa, vend AS id_vendedor, COALESCE(CAST(medio AS DOUBLE), 0.0) AS tempo_medio_compra FROM intervalos"""),
    "brand_profile": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(nivel AS BIGINT) AS nivel, m.codmarca AS id_marca,
        emp AS id_empresa, vend AS id_vendedor, posicao, nome, CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor, refforn, complemento
        FROM perfil_marcas m JOIN produtos USING (codprod)"""),
    "profile_lookup_customer": _sql(f"""SELECT {_t('dtref')}, CAST(nivel AS BIGINT) AS nivel, codparc AS id_cliente, emp AS id_empresa, vend AS id_vendedor,
        c_name AS nome_cliente, COALESCE(CAST(CAST((2 * ds * 100 + ng) // (2 * ng) AS DOUBLE) / 100 AS DOUBLE), 0.0) AS tempo_medio_compra,
        lista, posicao, nome, CAST(valor AS DOUBLE) AS valor, refforn, complemento
        FROM ({CUSTOMER_ENTRIES})
        JOIN (SELECT nivel, dtref, codparc, emp, vend, NULLIF(COUNT(DISTINCT data_ref) - 1, 0) AS ng, MAX(data_ref) - MIN(data_ref) AS ds
              FROM compras_nivel GROUP BY ALL) USING (nivel, dtref, codparc, emp, vend)
        JOIN customer ON c_custkey + 1 = codparc
        UNION ALL SELECT '1998-03-01', 3, c_custkey + 1, 0, 0, c_name, 0.0, NULL, NULL, NULL, NULL, NULL, NULL
        FROM customer ANTI JOIN (SELECT codparc - 1 AS c_custkey FROM compras_nivel WHERE nivel = 3 AND dtref = DATE '1998-03-01') USING (c_custkey)"""),
    "profile_lookup_brand": _sql(f"""SELECT {_t('dtref')}, CAST(nivel AS BIGINT) AS nivel, m.codmarca AS id_marca, emp AS id_empresa, vend AS id_vendedor,
        marca AS nome_marca, posicao, nome, CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor, refforn, complemento
        FROM perfil_marcas m JOIN produtos USING (codprod)
        UNION ALL SELECT '1998-03-01', 3, codmarca, 0, 0, marca, NULL, NULL, NULL, NULL, NULL
        FROM (SELECT DISTINCT codmarca, marca FROM produtos)
        ANTI JOIN (SELECT codmarca FROM perfil_marcas WHERE nivel = 3 AND dtref = DATE '1998-03-01') USING (codmarca)"""),
    "product_enrich": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(nivel AS BIGINT) AS nivel, m.codmarca AS id_marca, emp AS id_empresa, vend AS id_vendedor, posicao, p.nome_simples AS nome,
        CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor, d.refforn, d.complemento,
        'REF: ' || d.refforn || ' | COMP: ' || d.complemento AS subtitulo
        FROM perfil_marcas m JOIN produtos p USING (codprod)
        JOIN (SELECT UPPER(TRIM(nome_simples)) AS chave, refforn, complemento FROM produtos
              QUALIFY ROW_NUMBER() OVER (PARTITION BY UPPER(TRIM(nome_simples)) ORDER BY codprod) = 1) d
          ON d.chave = UPPER(TRIM(p.nome_simples))"""),
    "profile_share": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(nivel AS BIGINT) AS nivel, codparc AS id_cliente, emp AS id_empresa, vend AS id_vendedor, posicao, nome,
        CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor,
        CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE)
            / CAST(MAX(CAST(total AS DECIMAL(15,2))) OVER (PARTITION BY dtref, nivel, codparc, emp, vend) AS DOUBLE) * 100 AS percentual,
        'REF: ' || refforn || ' | COMP: ' || complemento AS subtitulo
        FROM perfil_produtos JOIN produtos USING (codprod)"""),
    "json_roundtrip": _sql(f"""SELECT {CUSTOMER_KEYS}, lista, posicao, nome, CAST(valor AS DOUBLE) AS valor, refforn, complemento
        FROM ({CUSTOMER_ENTRIES})"""),
    "companies": _sql("SELECT DISTINCT 'Empresa ' || id_empresa AS label, id_empresa AS value FROM fato WHERE id_empresa > 0"),
    "active_sellers": _sql(f"""SELECT DISTINCT CAST(dtref AS VARCHAR) AS dtref, id_vendedor, nome_comercial
        FROM fato_ciclo JOIN vendedores USING (id_vendedor) WHERE {MOVED}"""),
    "active_sellers_company": _sql(f"""SELECT DISTINCT CAST(dtref AS VARCHAR) AS dtref, id_vendedor || ' · ' || nome_comercial AS label,
        id_vendedor AS value FROM fato_ciclo JOIN vendedores USING (id_vendedor) WHERE {MOVED} AND id_empresa IN (1, 2)"""),
    "cycles": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref,
        ['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', 'Outubro', 'Novembro',
         'Dezembro'][month(dtref)] || ' / ' || year(dtref) AS label, dtinic || '|' || dtfin || '|' || dtref AS value,
        CAST(dtref = MAX(dtref) OVER () AS BIGINT) AS padrao FROM ciclos"""),
    "daily_performance": _sql(DAILY, ALL),
    "seller_stats": _sql(f"""SELECT {_t("dtref")}, id_vendedor, {_d("v_realizado", "v_devolucao", "v_cancelado", "v_desconto")}, v_tkts,
        CAST(taxa AS DOUBLE) AS v_taxa FROM por_vendedor LEFT JOIN taxas USING (id_vendedor)""", ALL),
    "goal_total": _sql("SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(meta AS DOUBLE) AS meta_total FROM metas_ciclo", ALL),
    "latest_rate": _sql("SELECT id_vendedor, CAST(id_tempo AS VARCHAR) AS id_tempo, id_empresa, CAST(taxa AS DOUBLE) AS taxa FROM taxas"),
    "kpi_summary": _sql(CARDS, ALL),
    "kpi_by_seller": _sql(f"""SELECT {_t("dtref")}, id_vendedor, COALESCE(CAST(v_realizado AS DOUBLE), 0) AS v_realizado,
        COALESCE(CAST(v_devolucao AS DOUBLE), 0) AS v_devolucao, COALESCE(CAST(v_cancelado AS DOUBLE), 0) AS v_cancelado,
        COALESCE(CAST(v_desconto AS DOUBLE), 0) AS v_desconto, COALESCE(v_tkts, 0) AS v_tkts,
        COALESCE(CAST(meta_vendedor AS DOUBLE), 0) AS meta_vendedor, COALESCE(linhas, 0) AS linhas
        FROM por_vendedor FULL JOIN meta_vend USING (dtref, id_vendedor)""", ALL),
    "kpi_two_cycles": _sql(f"""SELECT {_t("dtref")}, id_vendedor, COALESCE(CAST(v_realizado AS DOUBLE), 0) AS v_realizado,
        COALESCE(CAST(v_devolucao AS DOUBLE), 0) AS v_devolucao, COALESCE(CAST(v_cancelado AS DOUBLE), 0) AS v_cancelado,
        COALESCE(CAST(v_desconto AS DOUBLE), 0) AS v_desconto, COALESCE(v_tkts, 0) AS v_tkts,
        COALESCE(CAST(meta_vendedor AS DOUBLE), 0) AS meta_vendedor, COALESCE(linhas, 0) AS linhas
        FROM por_vendedor FULL JOIN meta_vend USING (dtref, id_vendedor) WHERE dtref IN (DATE '1998-03-01', DATE '1998-01-01')""", ALL),
    "kpi_half_period": _sql("""SELECT '1998-03-01' AS dtref, id_vendedor,
        CAST(COALESCE(SUM(valor_realizado) FILTER (WHERE id_empresa > 0), 0) AS DOUBLE) AS v_realizado,
        CAST(COALESCE(SUM(valor_devolucao) FILTER (WHERE id_empresa > 0), 0) AS DOUBLE) AS v_devolucao,
        CAST(COALESCE(SUM(valor_cancelado) FILTER (WHERE id_empresa > 0), 0) AS DOUBLE) AS v_cancelado,
        CAST(COALESCE(SUM(valor_desconto) FILTER (WHERE id_empresa > 0), 0) AS DOUBLE) AS v_desconto,
        CAST(COALESCE(SUM(qtd_transacoes) FILTER (WHERE id_empresa > 0), 0) AS BIGINT) AS v_tkts,
        CAST(COALESCE(MAX(valor_meta_mensal) FILTER (WHERE id_empresa = 0), 0) AS DOUBLE) AS meta_vendedor,
        COUNT(*) FILTER (WHERE id_empresa > 0) AS linhas FROM fato GROUP BY ALL"""),
    "top5_sellers": _sql(TOP, ALL),
    "kpi_company": _sql(CARDS, COMPANY_1),
    "kpi_company_daily": _sql(DAILY, COMPANIES_1_2),
    "kpi_company_top5": _sql(TOP, COMPANIES_2_3),
    "kpi_no_company": _sql(CARDS, NOTHING),
    "kpi_sellers": _sql(CARDS, _request(sellers="3, 5, 8")),
    "kpi_period": _sql(f"{CARDS} WHERE dtref = DATE '1998-03-01'", ALL),
    "kpi_derived": _sql(f"""SELECT {_t("dtref")}, {_d("meta", "realizado", "devolucao", "cancelado", "comissao", "desconto")}, tkts,
        ticket_medio, dias_com_venda, dias_uteis, atingimento, total_perdido, perc_perdido, perc_desconto, desconto_medio, projetado,
        perc_projetado, media_diaria, {_d("restante", "taxa_total", "premio")}, CAST(comissao + premio AS DOUBLE) AS remuneracao_total
        FROM finais""", ALL),
    "kpi_texts": _sql(f"""SELECT {_t("dtref")}, 'Resumo · ' || STRFTIME(dtref, '%m/%Y') AS titulo, {_brl("ticket_medio")} AS ticket_medio,
        {_tickets("tkts")} AS transacoes, {_brl("meta")} AS meta, {_brl("realizado")} AS realizado,
        'Proj. ' || {_compact("projetado")} AS projetado, {_pct("atingimento * 100")} AS perc_realizado,
        CASE WHEN meta > 0 THEN 'Estimativa: ' || {_pct("perc_projetado")} ELSE 'Sem Meta' END AS perc_projetado,
        CASE WHEN meta = 0 AND realizado > 0 THEN 'Superado' WHEN meta > 0 THEN {_brl("restante")} ELSE 'R$ 0,00' END AS restante,
        {_brl("media_diaria")} AS media_diaria, {_brl("total_perdido")} AS total_perdido, {_pct("perc_perdido")} AS perc_perdido,
        {_brl("devolucao")} AS devolucao, {_brl("cancelado")} AS cancelado, {_brl("desconto")} AS desconto,
        {_pct("perc_desconto")} AS perc_desconto, {_brl("desconto_medio")} AS desconto_medio, {_brl("comissao")} AS comissao,
        {_brl("premio")} AS premio, {_brl("comissao + premio")} AS remuneracao_total FROM finais""", ALL),
    "commission_tiers": _sql(f"""SELECT {_t("dtref")}, id_vendedor, {_d("realizado", "meta")}, atingimento, {_d("taxa_total", "comissao", "premio")},
        CAST(comissao + premio AS DOUBLE) AS remuneracao_total FROM (
        SELECT *, CAST(GREATEST(ROUND(CAST(realizado AS DECIMAL(18,2)) * taxa_total
                  - CAST(realizado AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(6,4)), 2), 0) AS DECIMAL(18,2)) AS premio,
               CAST(CAST(realizado AS DECIMAL(18,2)) * COALESCE(taxa, CAST(0.01 AS DECIMAL(18,10))) AS DECIMAL(24,2)) AS comissao
        FROM (SELECT *, {_tier("atingimento")} AS taxa_total FROM (
            SELECT dtref, id_vendedor, COALESCE(v_realizado, 0) AS realizado, COALESCE(meta_vendedor, 0) AS meta, taxa,
                   CASE WHEN COALESCE(meta_vendedor, 0) > 0
                        THEN CAST(COALESCE(v_realizado, 0) AS DOUBLE) / CAST(meta_vendedor AS DOUBLE) ELSE 0.0 END AS atingimento
            FROM por_vendedor FULL JOIN meta_vend USING (dtref, id_vendedor) LEFT JOIN taxas USING (id_vendedor))))""", ALL),
    "chart_daily": _sql("""SELECT CAST(dias.dtref AS VARCHAR) AS dtref, CAST(dia AS VARCHAR) AS date,
        COALESCE(CAST(realized AS DOUBLE), 0) AS realized,
        CASE WHEN util THEN CAST(cartoes.meta AS DOUBLE) / dias_uteis ELSE COALESCE(CAST(serie.meta AS DOUBLE), 0) END AS meta
        FROM dias JOIN uteis USING (dtref) JOIN cartoes USING (dtref) LEFT JOIN serie ON serie.dtref = dias.dtref AND date = dia""", ALL),
    "cycle_summary": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, UNNEST(['Meta', 'Realizado', 'Projetado', 'Falta']) AS rotulo,
        UNNEST([m, r, projetado, CAST(restante AS DOUBLE)]) AS valor FROM calculados""", ALL),
    "access_admin": _sql(CARDS, ALL),
    "access_manager": _sql(CARDS, COMPANIES_1_2),
    "access_seller": _sql(CARDS, _request(sellers="3")),
    "access_unknown": _sql(CARDS, NOTHING),
    "access_denied_seller": _sql("""SELECT usuario, CAST(ciclos.dtref AS VARCHAR) AS dtref,
        CAST(COALESCE(SUM(valor_realizado) FILTER (WHERE id_empresa > 0), 0) AS DOUBLE) AS realizado,
        CAST(COALESCE(MAX(valor_meta_mensal) FILTER (WHERE id_empresa = 0), 0) AS DOUBLE) AS meta
        FROM ciclos CROSS JOIN (VALUES ('admin'), ('manager'), ('stranded')) AS quem(usuario)
        LEFT JOIN fato_ciclo ON fato_ciclo.dtref = ciclos.dtref AND id_vendedor = 3
            AND (usuario = 'admin' OR usuario = 'manager' AND id_empresa IN (0, 1, 2))
        GROUP BY usuario, ciclos.dtref"""),
    "access_ranking": _sql(LOOKUP.format(rows="multi")),
    "access_profile": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, m.codmarca AS id_marca, emp AS id_empresa, posicao, nome,
        CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor
        FROM perfil_marcas m JOIN produtos USING (codprod) WHERE nivel = 1 AND emp = 1"""),
    "access_seller_list": _sql(f"""SELECT DISTINCT CAST(dtref AS VARCHAR) AS dtref, id_vendedor, nome_comercial
        FROM fato_ciclo JOIN vendedores USING (id_vendedor) WHERE {MOVED} AND id_vendedor = 3"""),
    "policy_view": _sql("""SELECT username, STRFTIME(id_tempo, '%Y-%m') AS ano_mes, CAST(SUM(valor_realizado) AS DOUBLE) AS realizado, COUNT(*) AS linhas
        FROM fato JOIN (VALUES ('chefe'), ('gerente1'), ('vendedor3')) u(username)
          ON username = 'chefe' OR (username = 'gerente1' AND id_empresa IN (1, 2)) OR (username = 'vendedor3' AND id_vendedor = 3) GROUP BY ALL"""),
    "policy_rows": _sql("""SELECT username, ano_mes, CAST(SUM(valor_realizado) AS DOUBLE) AS realizado, COUNT(DISTINCT (id_empresa, id_vendedor)) AS linhas
        FROM (SELECT 'gerente' || (r_regionkey + 1) AS username, STRFTIME(id_tempo, '%Y-%m') AS ano_mes, valor_realizado, id_empresa, id_vendedor
              FROM region JOIN fato ON id_empresa IN (r_regionkey + 1, (r_regionkey + 1) % 5 + 1) WHERE r_regionkey + 1 <> 5
              UNION ALL SELECT 'vendedor' || id_vendedor, STRFTIME(id_tempo, '%Y-%m'), valor_realizado, id_empresa, id_vendedor
              FROM fato JOIN vendedores USING (id_vendedor)) GROUP BY ALL"""),
    "report_formats": _sql(f"""SELECT {_t("dtref")}, id_vendedor, {_brl("COALESCE(v_desconto, 0)")} AS dinheiro,
        {_compact("COALESCE(v_realizado, 0)")} AS compacto,
        {_pct("CASE WHEN COALESCE(meta_vendedor, 0) > 0 THEN CAST(COALESCE(v_realizado, 0) AS DOUBLE) / CAST(meta_vendedor AS DOUBLE) ELSE 0.0 END * 100")} AS percentual,
        {_tickets("COALESCE(v_tkts, 0)")} AS transacoes
        FROM por_vendedor FULL JOIN meta_vend USING (dtref, id_vendedor)""", ALL),
    "upsert_fact": _sql(FACT.replace("CAST(valor_devolucao AS DOUBLE) AS valor_devolucao",
                                     "CASE WHEN id_tempo < DATE '1998-01-01' THEN 0 ELSE CAST(valor_devolucao AS DOUBLE) END AS valor_devolucao")),
    "upsert_rankings": _sql(RANK.replace("SELECT", "SELECT tipo,", 1) + " WHERE dtref < DATE '1998-01-01' OR posicao <= 3"),
    "dimension_sync": _sql("""SELECT 'dim_tempo_ref' AS tabela, CAST(dtref AS VARCHAR) AS id, ['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho',
            'Julho', 'Agosto', 'Setembro', 'Outubro', 'Novembro', 'Dezembro'][month(dtref)] || ' / ' || year(dtref) AS nome FROM ciclos
        UNION ALL SELECT 'dim_tempo_ref', '1900-01-01', NULL
        UNION ALL SELECT 'dim_vendedor', CAST(id_vendedor AS VARCHAR), nome_comercial FROM vendedores
        UNION ALL SELECT 'dim_empresa', CAST(r_regionkey + 1 AS VARCHAR), r_name FROM region UNION ALL SELECT 'dim_empresa', '0', 'CORPORATIVO (METAS)'
        UNION ALL SELECT 'dim_parceiro', CAST(c_custkey + 1 AS VARCHAR), c_name FROM customer
        UNION ALL SELECT DISTINCT 'dim_marca', CAST(codmarca AS VARCHAR), marca FROM produtos
        UNION ALL SELECT 'dim_produto', CAST(codprod AS VARCHAR), nome FROM produtos
        UNION ALL SELECT UNNEST(['dim_vendedor', 'dim_empresa', 'dim_parceiro', 'dim_marca', 'dim_produto']), '-1', NULL"""),
    "scd1_upsert": """SELECT c_custkey + 1 AS id_parceiro, CASE WHEN feito THEN c_name || ' (novo)' ELSE c_name END AS nome_parceiro
        FROM (SELECT *, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS feito FROM customer)
        WHERE feito OR c_acctbal >= 5000""",
    "upsert_profiles": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, CAST(nivel AS BIGINT) AS nivel, m.codmarca AS id_marca, emp AS id_empresa, vend AS id_vendedor, posicao, nome,
        CAST(CAST(total AS DECIMAL(15,2)) AS DOUBLE) AS valor, refforn, complemento
        FROM perfil_marcas m JOIN produtos USING (codprod) WHERE dtref >= DATE '1998-01-01' OR posicao = 1"""),
    "upsert_customer_profiles": _sql(f"""SELECT {CUSTOMER_KEYS}, lista, posicao, nome, CAST(valor AS DOUBLE) AS valor, refforn, complemento
        FROM ({CUSTOMER_ENTRIES}) WHERE dtref >= DATE '1998-01-01' OR posicao = 1 OR lista = 'VENDEDOR'"""),
    "insert_days": _sql("""SELECT DISTINCT CAST(id_tempo AS VARCHAR) AS id_tempo, month(id_tempo) AS mes,
        CASE WHEN id_tempo <= DATE '1998-03-31' THEN 'primeira carga' END AS nome_mes FROM fato"""),
    "erp_movements": """SELECT CAST(dia AS VARCHAR) AS data_ref, tipo_mov, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS valor FROM (
        SELECT CAST(l_extendedprice AS DECIMAL(15,2)) - CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)) AS valor,
               CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + 1 ELSE CAST(o_orderdate AS DATE) END AS dia,
               CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 4 < 2 AND o_orderkey % 3 = 0 THEN 'C' END
                    WHEN o_orderkey % 4 < 2 THEN CASE WHEN o_orderkey % 7 > 0 THEN 'V' END
                    WHEN o_orderkey % 4 = 2 THEN 'D' END AS tipo_mov
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE tipo_mov IS NOT NULL GROUP BY ALL""",
    "quality_report": _sql("""SELECT 'chave unica do fato' AS regra, COUNT(*) AS violacoes
            FROM (SELECT 1 FROM fato GROUP BY id_tempo, id_vendedor, id_empresa HAVING COUNT(*) > 1)
        UNION ALL SELECT 'chave unica do ranking', COUNT(*)
            FROM (SELECT 1 FROM ranks GROUP BY dtref, nivel, id_vendedor, id_empresa, tipo, posicao HAVING COUNT(*) > 1)
        UNION ALL SELECT 'chave unica do perfil de marca', COUNT(*)
            FROM (SELECT 1 FROM perfil_marcas GROUP BY dtref, nivel, codmarca, emp, vend, posicao HAVING COUNT(*) > 1)
        UNION ALL SELECT 'chave unica do perfil de cliente', COUNT(*)
            FROM (SELECT 1 FROM intervalos GROUP BY dtref, nivel, codparc, emp, vend HAVING COUNT(*) > 1)
        UNION ALL SELECT 'vendedor sem dimensao', COUNT(DISTINCT id_vendedor) FROM fato ANTI JOIN vendedores USING (id_vendedor)
        UNION ALL SELECT 'medidas nulas', COUNT(*) FROM fato
            WHERE valor_meta_diaria IS NULL OR valor_meta_mensal IS NULL OR valor_realizado IS NULL OR valor_devolucao IS NULL
                OR valor_cancelado IS NULL OR valor_comissao IS NULL OR valor_desconto IS NULL OR qtd_transacoes IS NULL
        UNION ALL SELECT 'quantidade positiva', COUNT(*) FROM linhas WHERE NOT qtdneg > 0
        UNION ALL SELECT 'valor nao negativo', COUNT(*) FROM linhas WHERE NOT vlrtot - vlrdesc >= 0
        UNION ALL SELECT 'mes entre 1 e 12', COUNT(*) FROM ciclos WHERE NOT (year(dtref) * 100 + month(dtref)) % 100 BETWEEN 1 AND 12
        UNION ALL SELECT 'meta so na empresa 0', COUNT(*) FROM fato WHERE id_empresa > 0 AND valor_meta_diaria <> 0
        UNION ALL SELECT 'item repetido na origem', COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)"""),
    "backfill_range": _sql(f"{FACT} WHERE id_tempo BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'"),
    "backfill_status": _sql("""SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS id_tempo, COALESCE(n, 0) AS linhas,
        CASE WHEN n IS NULL THEN 'sem movimento' ELSE 'carregado' END AS situacao
        FROM (SELECT UNNEST(generate_series(TIMESTAMP '2001-09-01', TIMESTAMP '2002-01-31', INTERVAL 1 DAY)) AS d)
        LEFT JOIN (SELECT id_tempo, COUNT(*) AS n FROM fato GROUP BY ALL) ON id_tempo = CAST(d AS DATE)"""),
    "load_quarantine": _sql("""SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS id_tempo,
        CASE WHEN r > 0 THEN 'falhou' WHEN n IS NULL THEN 'sem movimento' ELSE 'carregado' END AS situacao,
        CASE WHEN r > 0 THEN 0 ELSE COALESCE(n, 0) END AS gravadas, COALESCE(r, 0) AS rejeitadas
        FROM (SELECT UNNEST(generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-06-30', INTERVAL 1 DAY)) AS d)
        LEFT JOIN (SELECT id_tempo, COUNT(*) AS n FROM fato GROUP BY ALL) ON id_tempo = CAST(d AS DATE)
        LEFT JOIN (SELECT data_ref, COUNT(*) AS r FROM linhas WHERE nunota % 499 = 0 OR nunota % 503 = 0 GROUP BY ALL) ON data_ref = CAST(d AS DATE)"""),
    "increments_merged": _sql(FACT),
    "stream_late": _sql(FACT),
    "stream_late_days": """
        WITH fim AS (SELECT CAST(MAX(d) AS DATE) AS ultimo FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)),
        pedidos AS (SELECT o_orderkey AS k, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS dia, CAST(o_orderdate AS DATE) < ultimo - 400 AS antigo FROM orders, fim),
        versoes AS (
            SELECT k, st, dia, CAST(DATE_TRUNC('month', dia + CASE WHEN k % 97 = 0 THEN 90 WHEN k % 61 = 0 AND antigo THEN 180 ELSE 0 END) + INTERVAL 1 MONTH AS DATE) AS carga
            FROM pedidos
            UNION ALL SELECT k, 'O', dia - 1, CAST(DATE_TRUNC('month', dia) AS DATE) FROM pedidos WHERE k % 5 = 0 AND (k % 61 <> 0 OR NOT antigo)),
        chegadas AS (
            SELECT k, l_returnflag AS f, CAST(l_shipdate AS DATE) AS envio,
                   CAST(DATE_TRUNC('month', dia + CASE WHEN k % 31 = 0 THEN 70 ELSE l_linenumber END) + INTERVAL 1 MONTH AS DATE) AS carga
            FROM lineitem JOIN pedidos ON k = l_orderkey),
        vistas AS (
            SELECT c.k, CASE WHEN st <> 'P' AND f = 'R' THEN envio ELSE dia END AS ref, c.carga AS ci, v.carga AS cv
            FROM chegadas c JOIN versoes v ON v.k = c.k AND ABS(DATE_DIFF('day', c.carga, v.carga)) <= 120),
        quando AS (
            SELECT ref, GREATEST(ci, cv) AS carga FROM vistas
            UNION ALL SELECT ref, GREATEST(ci, n.carga) FROM vistas JOIN versoes n ON n.k = vistas.k AND n.carga > cv AND n.carga <= cv + 120)
        SELECT DISTINCT CAST(ref AS VARCHAR) AS id_tempo FROM quando WHERE DATE_DIFF('day', ref, carga) > 60""",
    "stream_refresh": _sql(FACT),
    "ticket_row_avg": _sql(f"""SELECT {_t("mes")}, {_mean("SUM(valor)", "COUNT(*)")} AS ticket_medio FROM vendas_linha WHERE tipo = 'V'
        GROUP BY ALL""", REPORT),
    "sales_by_seller": _sql(f"""SELECT {_t("mes")}, id_vendedor, nome_comercial AS name, COUNT(*) AS qtd_vendas,
        CAST(SUM(valor) AS DOUBLE) AS total_vendas, {_mean("SUM(valor)", "COUNT(*)")} AS ticket_medio
        FROM vendas_linha JOIN vendedores USING (id_vendedor) WHERE tipo = 'V' GROUP BY ALL""", REPORT),
    "perf_vs_goal": _sql(f"""SELECT CAST(dtref AS VARCHAR) AS mes, codvend AS id_vendedor, CAST(meta_mensal AS DOUBLE) AS meta,
        nome_comercial AS name, CAST(vendido AS DOUBLE) AS vendido, {_mean("vendido * 10000", "CAST(meta_mensal * 100 AS HUGEINT)")} AS percentual_meta
        FROM (SELECT dtref, codvend, meta_mensal, COALESCE(SUM(valor), 0) AS vendido FROM metas
              LEFT JOIN vendas_linha ON mes = dtref AND id_vendedor = codvend AND tipo = 'V' GROUP BY ALL)
        JOIN vendedores ON id_vendedor = codvend""", REPORT),
    "cancel_rate": _sql(f"""SELECT {_t("mes")}, id_vendedor, nome_comercial AS name, COUNT(*) FILTER (WHERE tipo = 'C') AS qtd_canceladas,
        COUNT(*) AS qtd_total, {_mean("COUNT(*) FILTER (WHERE tipo = 'C') * 100", "COUNT(*)")} AS taxa_cancelamento
        FROM vendas_linha JOIN vendedores USING (id_vendedor) GROUP BY ALL""", REPORT),
    "current_month": _sql("""SELECT CAST(mes AS VARCHAR) AS mes, id_vendedor, COUNT(*) AS qtd_vendas, CAST(SUM(valor) AS DOUBLE) AS total,
        nome_comercial AS name FROM vendas_linha JOIN vendedores USING (id_vendedor)
        WHERE mes = (SELECT CAST(DATE_TRUNC('month', MAX(o_orderdate)) AS DATE) FROM orders) GROUP BY ALL""", REPORT),
    "manager_semi": _sql(f"""SELECT STRFTIME(id_tempo, '%Y-%m') AS ano_mes, CAST(SUM(valor_realizado) AS DOUBLE) AS realizado
        FROM fato WHERE id_empresa > 0 AND id_vendedor IN (SELECT id_vendedor FROM fato WHERE id_empresa IN (1, 2) AND {MOVED})
        GROUP BY ALL"""),
    "conversion_rate": """SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'signup') AS leads,
        COUNT(*) FILTER (WHERE event_type = 'purchase') AS vendas,
        CASE WHEN leads > 0 THEN CAST(vendas AS DOUBLE) / CAST(leads AS DOUBLE) ELSE 0.0 END AS conversao FROM events GROUP BY ALL""",
    "category_share": _sql("""SELECT refforn, CAST(v AS DOUBLE) AS valor, CAST(v AS DOUBLE) / CAST(SUM(v) OVER () AS DOUBLE) * 100 AS percentual
        FROM (SELECT refforn, SUM(vlrtot - vlrdesc) AS v FROM linhas JOIN produtos USING (codprod) WHERE tipo = 'V' GROUP BY ALL)"""),
    "region_share": _sql("""SELECT ano_mes, id_empresa, CAST(v AS DOUBLE) AS valor, CASE WHEN t <> 0 THEN CAST(v AS DOUBLE) / t * 100 ELSE 0.0 END AS percentual
        FROM (SELECT *, CAST(SUM(v) OVER (PARTITION BY ano_mes) AS DOUBLE) AS t FROM (
            SELECT STRFTIME(id_tempo, '%Y-%m') AS ano_mes, id_empresa, SUM(valor_realizado) AS v FROM fato WHERE id_empresa > 0 GROUP BY ALL))"""),
    "period_matrix": _sql("""SELECT id_vendedor, year(mes) AS ano, """ + ", ".join(
        f"COALESCE(CAST(SUM(valor) FILTER (WHERE quarter(mes) = {q}) AS DOUBLE), 0) AS t{q}" for q in (1, 2, 3, 4)
    ) + " FROM vendas_linha WHERE tipo = 'V' GROUP BY ALL", REPORT),
    "ticket_vs_cancel": _sql("""SELECT id_vendedor, CASE WHEN t > 0 THEN CAST(r AS DOUBLE) / t ELSE 0.0 END AS ticket_medio,
        CASE WHEN r + c > 0 THEN CAST(c AS DOUBLE) / (CAST(r AS DOUBLE) + CAST(c AS DOUBLE)) ELSE 0.0 END AS parte_cancelada
        FROM (SELECT id_vendedor, SUM(v_realizado) AS r, SUM(v_cancelado) AS c, SUM(v_tkts) AS t FROM por_vendedor GROUP BY ALL)""", ALL),
    "grain_day": _sql("""SELECT CAST(id_tempo AS VARCHAR) AS periodo, CAST(SUM(valor_realizado) AS DOUBLE) AS realizado, 'day' AS grao
        FROM fato WHERE id_empresa > 0 GROUP BY ALL"""),
    "grain_month": _sql("""SELECT CAST(CAST(DATE_TRUNC('month', id_tempo) AS DATE) AS VARCHAR) AS periodo, CAST(SUM(valor_realizado) AS DOUBLE) AS realizado,
        'month' AS grao FROM fato WHERE id_empresa > 0 GROUP BY ALL"""),
    "grain_quarter": _sql("""SELECT CAST(CAST(DATE_TRUNC('quarter', id_tempo) AS DATE) AS VARCHAR) AS periodo, CAST(SUM(valor_realizado) AS DOUBLE) AS realizado,
        'quarter' AS grao FROM fato WHERE id_empresa > 0 GROUP BY ALL"""),
    "growth_delta": _sql("""SELECT CAST(dtref AS VARCHAR) AS dtref, id_empresa, CAST(v AS DOUBLE) AS realizado, CAST(a AS DOUBLE) AS anterior,
        CASE WHEN a <> 0 THEN (CAST(v AS DOUBLE) - CAST(a AS DOUBLE)) / CAST(a AS DOUBLE) * 100 END AS variacao,
        CASE WHEN a IS NULL THEN NULL WHEN v > a THEN 'alta' WHEN v < a THEN 'queda' ELSE 'estável' END AS tendencia
        FROM (SELECT *, LAG(COALESCE(v, 0)) OVER (PARTITION BY id_empresa ORDER BY dtref) AS a
            FROM (SELECT dtref, r_regionkey + 1 AS id_empresa FROM ciclos, region)
            LEFT JOIN (SELECT dtref, id_empresa, SUM(valor_realizado) AS v FROM fato_ciclo WHERE id_empresa > 0 GROUP BY ALL) USING (dtref, id_empresa))
        WHERE v IS NOT NULL"""),
}
