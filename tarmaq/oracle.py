"""The same results in DuckDB SQL, written against the benchmark tables only.

``VIEWS`` are common table expressions; each query names the ones it needs, in any depth.
"""

from __future__ import annotations

import re

VIEWS = {
    "base": """
        SELECT *,
          CASE WHEN l_orderkey % 33 = 0 THEN NULL
               ELSE l_shipdate + to_minutes(CAST(l_orderkey % 1440 AS INT)) END AS sd,
          30 + l_linenumber * 35 AS dur,
          (l_partkey % 180) - 60 + CASE WHEN l_partkey % 101 = 0 THEN 2000
                                        WHEN l_partkey % 103 = 0 THEN -300 ELSE 0 END AS dd,
          (l_suppkey % 41) - 20 AS rec,
          (l_returnflag = 'A' AND l_linenumber = 1) AS canc
        FROM lineitem""",
    "typed": """
        SELECT l_orderkey,
          'A' || lpad(CAST(l_suppkey % 120 AS VARCHAR), 3, '0') AS icao_airline,
          CAST(l_orderkey AS VARCHAR) AS flight_number,
          CAST(l_suppkey % 11 AS VARCHAR) AS di_code,
          substr('NCIGX', CAST(l_partkey % 5 AS INT) + 1, 1) AS line_type_code,
          'S' || substr('BDXK', CAST(l_partkey % 4 AS INT) + 1, 1)
              || lpad(CAST(l_partkey % 30 AS VARCHAR), 2, '0') AS icao_origin,
          'S' || substr('BDXK', CAST(l_orderkey % 4 AS INT) + 1, 1)
              || lpad(CAST(l_orderkey % 30 AS VARCHAR), 2, '0') AS icao_destination,
          sd AS scheduled_departure,
          CASE WHEN NOT canc
               THEN coalesce(sd, l_shipdate) + to_minutes(CAST(dd AS INT)) END AS actual_departure,
          CASE WHEN l_orderkey % 37 = 0 THEN sd - to_minutes(10)
               ELSE sd + to_minutes(CAST(dur AS INT)) END AS scheduled_arrival,
          CASE WHEN canc THEN NULL
               WHEN l_orderkey % 53 = 0
               THEN coalesce(sd, l_shipdate) + to_minutes(CAST(dd - 5 AS INT))
               ELSE coalesce(sd, l_shipdate) + to_minutes(CAST(dur + dd - rec AS INT))
          END AS actual_arrival,
          CASE WHEN l_orderkey % 211 = 0 THEN 'DESCONHECIDO'
               WHEN l_orderkey % 223 = 0 THEN NULL
               WHEN canc THEN 'CANCELADO' ELSE 'REALIZADO' END AS flight_status
        FROM base""",
    "delivered": """
        SELECT *, 'VRA_' || CAST(l_orderkey % 12 AS VARCHAR) || '.csv' AS _arquivo_origem
        FROM typed
        UNION ALL
        SELECT *, 'VRA_dup.csv' FROM typed WHERE l_orderkey % 500 = 0""",
    "bronze": """
        SELECT * REPLACE (
          coalesce(CAST(scheduled_departure AS VARCHAR), 'null') AS scheduled_departure,
          coalesce(CAST(actual_departure AS VARCHAR), 'null') AS actual_departure,
          coalesce(CAST(scheduled_arrival AS VARCHAR), 'null') AS scheduled_arrival,
          coalesce(CAST(actual_arrival AS VARCHAR), 'null') AS actual_arrival)
        FROM delivered""",
    "silver": """
        SELECT icao_airline, flight_number, di_code, line_type_code, icao_origin, icao_destination,
          scheduled_departure, actual_departure, scheduled_arrival, actual_arrival,
          CAST(scheduled_departure AS DATE) AS scheduled_departure_date,
          strftime(scheduled_departure, '%H:%M') AS scheduled_departure_time,
          CAST(actual_departure AS DATE) AS actual_departure_date,
          strftime(actual_departure, '%H:%M') AS actual_departure_time,
          CAST(scheduled_arrival AS DATE) AS scheduled_arrival_date,
          strftime(scheduled_arrival, '%H:%M') AS scheduled_arrival_time,
          CAST(actual_arrival AS DATE) AS actual_arrival_date,
          strftime(actual_arrival, '%H:%M') AS actual_arrival_time,
          flight_status, CASE WHEN l_orderkey % 7 = 0
            THEN 'J' || CAST(l_orderkey % 9 AS VARCHAR) END AS justification_code,
          CAST(date_sub('minute', scheduled_departure, actual_departure) AS INT)
            AS departure_delay_min,
          CAST(date_sub('minute', scheduled_arrival, actual_arrival) AS INT) AS arrival_delay_min,
          CAST(date_sub('minute', scheduled_departure, actual_departure)
             - date_sub('minute', scheduled_arrival, actual_arrival) AS INT) AS minutes_recovered,
          _arquivo_origem
        FROM delivered""",
    "airlines": """
        SELECT CASE WHEN s_suppkey % 13 = 0 THEN ''
                    ELSE 'A' || lpad(CAST(s_suppkey % 90 AS VARCHAR), 3, '0') END AS icao,
          'I' || CAST(s_suppkey % 36 AS VARCHAR) AS iata_code, s_name AS legal_name,
          CASE WHEN s_suppkey % 2 = 0 THEN 'Regular' END AS service,
          'Cidade ' || CAST(s_nationkey AS VARCHAR) AS city,
          CASE WHEN s_nationkey < 13 THEN 'U' || CAST(s_nationkey % 5 AS VARCHAR) END AS state,
          CASE WHEN s_acctbal >= 5000 THEN 'ATIVA' ELSE 'INATIVA' END AS status,
          CASE WHEN s_nationkey < 13 THEN 'national' ELSE 'foreign' END AS registry_origin,
          CASE WHEN s_nationkey < 13 THEN 'national.csv' ELSE 'foreign.csv' END AS _arquivo_origem
        FROM supplier""",
    "raw_aerodromes": """
        SELECT 'S' || substr('BDXK', n_nationkey % 4 + 1, 1)
                   || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS icao,
          n_name AS name, 'Cidade ' || n_name AS municipality, r_name AS state_name,
          CASE WHEN n_nationkey % 7 = 0 THEN 'N/D'
               ELSE CAST(n_nationkey * 37 AS VARCHAR) || ',' || CAST(n_nationkey % 10 AS VARCHAR)
          END AS altitude, 'CI' || CAST(n_nationkey AS VARCHAR) AS ciad,
          'Perto de ' || n_name AS served_municipality,
          CASE WHEN n_nationkey % 2 = 0 THEN r_name END AS served_state_name,
          CAST(n_nationkey AS VARCHAR) || 'S' AS latitude_dms,
          CAST(n_nationkey AS VARCHAR) || 'W' AS longitude_dms,
          CASE WHEN n_nationkey % 3 <> 0 THEN 'Cadastrado' END AS status
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT 'S' || substr('BDXK', n_nationkey % 4 + 1, 1)
                   || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'),
          'Z ' || n_name, NULL, NULL, '10,5', NULL, NULL, NULL, NULL, NULL, NULL
        FROM nation WHERE n_nationkey < 3""",
    "aerodromes": """
        SELECT icao, ciad, name, municipality, state_name, served_municipality,
          served_state_name, latitude_dms, longitude_dms,
          TRY_CAST(replace(altitude, ',', '.') AS DOUBLE) AS altitude_m, status
        FROM raw_aerodromes""",
    "codes": """
        SELECT * FROM (VALUES
          ('di_code', '0', 'Etapa Regular'), ('di_code', '2', 'Etapa Extra'),
          ('di_code', '3', 'Etapa de Retorno'), ('di_code', '4', 'Inclusão de Etapa'),
          ('di_code', '6', 'Etapa Não Remunerada Sem Transporte de Objetos'),
          ('di_code', '7', 'Etapa de Voo de Fretamento'), ('di_code', '9', 'Etapa de Voo Charter'),
          ('di_code', 'D', 'Etapa de Voo Duplicada'),
          ('di_code', 'E', 'Etapa Não Remunerada Com Transporte de Objetos'),
          ('line_type_code', 'N', 'Doméstica Mista'), ('line_type_code', 'C', 'Doméstica Cargueira'),
          ('line_type_code', 'I', 'Internacional Mista'),
          ('line_type_code', 'G', 'Internacional Cargueira')) AS seed(domain, code, description)""",
    "marked": """
        SELECT *,
          EXISTS (SELECT 1 FROM aerodromes a WHERE a.icao = s.icao_origin) AS origem_no_cadastro,
          EXISTS (SELECT 1 FROM aerodromes a WHERE a.icao = s.icao_destination)
            AS destino_no_cadastro,
          EXISTS (SELECT 1 FROM airlines a WHERE a.icao = s.icao_airline AND a.icao <> '')
            AS empresa_no_cadastro
        FROM silver s""",
    "judged": """
        SELECT *,
          scheduled_departure IS NOT NULL AND scheduled_arrival IS NOT NULL AS r1,
          flight_status IS NOT NULL AND flight_status IN ('REALIZADO', 'CANCELADO') AS r2,
          coalesce(scheduled_arrival > scheduled_departure, TRUE) AS r3,
          coalesce(actual_arrival > actual_departure, TRUE) AS r4,
          coalesce(departure_delay_min BETWEEN -120 AND 1440, TRUE) AS r5,
          coalesce(arrival_delay_min BETWEEN -120 AND 1440, TRUE) AS r6,
          empresa_no_cadastro AS r7, origem_no_cadastro AS r8, destino_no_cadastro AS r9
        FROM marked""",
    "rules": """
        SELECT * FROM (VALUES
          (1, 'horarios_previstos_presentes'), (2, 'situacao_voo_conhecida'),
          (3, 'chegada_prevista_depois_da_partida_prevista'),
          (4, 'chegada_real_depois_da_partida_real'), (5, 'atraso_partida_plausivel'),
          (6, 'atraso_chegada_plausivel'), (7, 'empresa_no_cadastro_anac'),
          (8, 'aeroporto_origem_no_cadastro_anac'),
          (9, 'aeroporto_destino_no_cadastro_anac')) AS listed(id, rule)""",
    "verdicts": """
        SELECT rule, passes FROM (
          SELECT [r1, r2, r3, r4, r5, r6, r7, r8, r9][id] AS passes, rule FROM judged, rules)""",
    "quarantined": """
        SELECT * EXCLUDE (r1, r2, r3, r4, r5, r6, r7, r8, r9),
          concat_ws(' | ',
            CASE WHEN NOT r1 THEN 'horarios_previstos_presentes' END,
            CASE WHEN NOT r2 THEN 'situacao_voo_conhecida' END,
            CASE WHEN NOT r3 THEN 'chegada_prevista_depois_da_partida_prevista' END,
            CASE WHEN NOT r4 THEN 'chegada_real_depois_da_partida_real' END,
            CASE WHEN NOT r5 THEN 'atraso_partida_plausivel' END,
            CASE WHEN NOT r6 THEN 'atraso_chegada_plausivel' END,
            CASE WHEN NOT r7 THEN 'empresa_no_cadastro_anac' END,
            CASE WHEN NOT r8 THEN 'aeroporto_origem_no_cadastro_anac' END,
            CASE WHEN NOT r9 THEN 'aeroporto_destino_no_cadastro_anac' END) AS motivos_quarentena
        FROM judged WHERE NOT (r1 AND r2 AND r3 AND r4 AND r5 AND r6 AND r7 AND r8 AND r9)""",
    "masked": """
        SELECT * EXCLUDE (departure_delay_min, arrival_delay_min, minutes_recovered, wild),
          wild AS delay_out_of_range,
          CASE WHEN NOT wild THEN departure_delay_min END AS departure_delay_min,
          CASE WHEN NOT wild THEN arrival_delay_min END AS arrival_delay_min,
          CASE WHEN NOT wild THEN minutes_recovered END AS minutes_recovered
        FROM (SELECT *,
                NOT (coalesce(departure_delay_min BETWEEN -120 AND 1440, TRUE)
                     AND coalesce(arrival_delay_min BETWEEN -120 AND 1440, TRUE)) AS wild
              FROM silver)""",
    "best_airlines": """
        SELECT icao, legal_name, registry_origin FROM airlines WHERE icao <> ''
        QUALIFY row_number() OVER (PARTITION BY icao
          ORDER BY (status <> 'ATIVA'), legal_name, registry_origin) = 1""",
    "first_aerodromes": """
        SELECT icao, name, municipality, state_name FROM aerodromes
        QUALIFY row_number() OVER (PARTITION BY icao ORDER BY name) = 1""",
    "airport_codes": """
        SELECT icao_origin AS icao_airport FROM silver
        UNION SELECT icao_destination FROM silver""",
    "airports": """
        SELECT icao_airport,
          coalesce(name, 'AEROPORTO FORA DO CADASTRO ANAC (' || icao_airport || ')')
            AS airport_name,
          municipality AS airport_municipality, state_name AS airport_state,
          CASE WHEN regexp_matches(icao_airport, '^S[BDIJNSW]')
               THEN 'Brasil' ELSE 'Exterior' END AS airport_country,
          icao IS NOT NULL AS in_anac_registry
        FROM airport_codes LEFT JOIN first_aerodromes ON icao_airport = icao""",
    "fact": """
        SELECT m.icao_airline,
          coalesce(a.legal_name, 'COMPANHIA NAO CADASTRADA (' || m.icao_airline || ')')
            AS airline_name,
          a.registry_origin AS airline_registry, m.flight_number, m.di_code,
          coalesce(d.description, 'Codigo nao catalogado (' || m.di_code || ')') AS di_description,
          m.line_type_code,
          coalesce(t.description, 'Codigo nao catalogado (' || m.line_type_code || ')')
            AS line_type_description,
          CASE WHEN m.line_type_code IN ('N', 'C') THEN 'Domestico'
               WHEN m.line_type_code IN ('I', 'G') THEN 'Internacional'
               ELSE 'Nao classificado' END AS flight_scope,
          m.icao_origin, m.icao_destination,
          m.icao_origin || ' - ' || m.icao_destination AS route,
          m.scheduled_departure, m.scheduled_departure_date, m.scheduled_departure_time,
          CAST(hour(m.scheduled_departure) AS INT) AS scheduled_departure_hour,
          ['domingo', 'segunda', 'terca', 'quarta', 'quinta', 'sexta', 'sabado']
            [dayofweek(m.scheduled_departure_date) + 1] AS day_of_week,
          CAST(date_trunc('month', m.scheduled_departure_date) AS DATE) AS reference_month,
          m.actual_departure, m.scheduled_arrival, m.actual_arrival,
          m.departure_delay_min, m.arrival_delay_min, m.minutes_recovered, m.delay_out_of_range,
          m.departure_delay_min <= 15 AS departure_punctual,
          m.arrival_delay_min <= 15 AS arrival_punctual,
          m.flight_status,
          m.flight_status = 'CANCELADO' AS flight_cancelled,
          m.flight_status = 'REALIZADO' AS flight_completed
        FROM (SELECT DISTINCT * EXCLUDE (_arquivo_origem) FROM masked) m
        LEFT JOIN best_airlines a ON m.icao_airline = a.icao
        LEFT JOIN codes d ON d.domain = 'di_code' AND d.code = m.di_code
        LEFT JOIN codes t ON t.domain = 'line_type_code' AND t.code = m.line_type_code""",
    "obt": """
        SELECT f.* EXCLUDE (airline_registry, route), f.route AS route_icao,
          o.airport_name AS origin_airport_name, o.airport_municipality AS origin_municipality,
          o.airport_state AS origin_state, o.airport_country AS origin_country,
          d.airport_name AS destination_airport_name,
          d.airport_municipality AS destination_municipality,
          d.airport_state AS destination_state, d.airport_country AS destination_country,
          coalesce(o.airport_municipality, f.icao_origin) || ' - '
            || coalesce(d.airport_municipality, f.icao_destination) AS route_municipalities
        FROM fact f
        LEFT JOIN airports o ON o.icao_airport = f.icao_origin
        LEFT JOIN airports d ON d.icao_airport = f.icao_destination""",
}

STEP_KEYS = ("icao_airline, flight_number, di_code, line_type_code, icao_origin, "
             "icao_destination, scheduled_departure, actual_departure, scheduled_arrival, "
             "actual_arrival, flight_status")

QUERIES = {
    "audit_load_summary": """
        SELECT _arquivo_origem, count(*) AS rows, max(scheduled_departure) AS latest_departure
        FROM bronze GROUP BY _arquivo_origem""",
    "seed_codes": """
        SELECT domain, code, description,
          CAST(CASE domain WHEN 'di_code' THEN (SELECT count(*) FROM silver WHERE di_code = code)
               ELSE (SELECT count(*) FROM silver WHERE line_type_code = code) END AS BIGINT)
            AS flight_steps
        FROM codes""",
    "missing_token_profile": " UNION ALL ".join(
        f"""SELECT '{source}' AS column_name, count(*) AS rows,
              count(*) FILTER ({column} IS NULL) AS truly_null,
              count(*) FILTER ({column} = 'null') AS token_text,
              count(*) FILTER ({column} LIKE '%.%') AS with_fragment
            FROM bronze"""
        for source, column in [
            ("Partida Prevista", "scheduled_departure"), ("Partida Real", "actual_departure"),
            ("Chegada Prevista", "scheduled_arrival"), ("Chegada Real", "actual_arrival")]),
    "typed_mirror": "SELECT * FROM silver",
    "typing_completeness": "SELECT " + ", ".join(
        f"count({column}) AS {column}_ok" for column in [
            "scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival",
            "departure_delay_min", "arrival_delay_min", "minutes_recovered"]) + " FROM silver",
    "decimal_comma_cast": "SELECT * FROM aerodromes",
    "decimal_comma_balances": """
        SELECT c_custkey, CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal END AS balance
        FROM customer""",
    "conform_union": "SELECT * FROM airlines",
    "registry_key_coverage": """
        SELECT registry_origin, count(*) AS rows, count(*) FILTER (icao <> '') AS with_key
        FROM airlines GROUP BY registry_origin""",
    "key_filter_in_list": """
        SELECT icao, legal_name, status, registry_origin FROM airlines
        WHERE icao IN ('A001', 'A013', 'A026', 'A089')""",
    "segment_in_list": """
        SELECT c_mktsegment, c_nationkey, count(*) AS customers, max(c_acctbal) AS highest_balance
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY ALL""",
    "first_departures": """
        SELECT icao_airline, flight_number, icao_origin, icao_destination, scheduled_departure,
          scheduled_departure_date, scheduled_departure_time, departure_delay_min,
          arrival_delay_min, minutes_recovered, flight_status
        FROM silver
        ORDER BY scheduled_departure NULLS FIRST, icao_airline NULLS FIRST,
          flight_number NULLS FIRST, icao_origin NULLS FIRST, icao_destination NULLS FIRST,
          scheduled_departure_date NULLS FIRST, scheduled_departure_time NULLS FIRST,
          departure_delay_min NULLS FIRST, arrival_delay_min NULLS FIRST,
          minutes_recovered NULLS FIRST, flight_status NULLS FIRST
        LIMIT 5""",
    "membership_flags": f"""
        SELECT {STEP_KEYS}, _arquivo_origem, origem_no_cadastro, destino_no_cadastro,
          empresa_no_cadastro
        FROM marked""",
    "expectation_metrics": """
        SELECT rule, count(*) FILTER (passes) AS passed, count(*) FILTER (NOT passes) AS failed
        FROM verdicts GROUP BY rule""",
    "quarantine_rows": "SELECT * FROM quarantined",
    "violation_distribution": """
        SELECT rule AS reason, count(*) AS rows,
          count(*)::DOUBLE * 100.0::DOUBLE / (SELECT count(*) FROM silver)::DOUBLE AS pct_of_rows
        FROM verdicts WHERE NOT passes GROUP BY rule""",
    "quarantine_share": """
        SELECT count(*) AS quarantined, (SELECT count(*) FROM silver) AS audited,
          count(*)::DOUBLE * 100.0::DOUBLE / (SELECT count(*) FROM silver)::DOUBLE
            AS pct_quarantined
        FROM quarantined""",
    "reconcile_counts": """
        SELECT table_name, source_rows, target_rows, source_rows - target_rows AS difference
        FROM (SELECT 'flights' AS table_name, (SELECT count(*) FROM bronze) AS source_rows,
                     (SELECT count(*) FROM silver) AS target_rows
              UNION ALL SELECT 'airlines', (SELECT count(*) FROM supplier),
                     (SELECT count(*) FROM airlines)
              UNION ALL SELECT 'aerodromes', (SELECT count(*) FROM raw_aerodromes),
                     (SELECT count(*) FROM aerodromes))""",
    "plausibility_mask": f"""
        SELECT {STEP_KEYS}, _arquivo_origem, delay_out_of_range, departure_delay_min,
          arrival_delay_min, minutes_recovered
        FROM masked""",
    "dedup_exact": f"""
        SELECT * FROM silver
        QUALIFY row_number() OVER (PARTITION BY {STEP_KEYS} ORDER BY _arquivo_origem) = 1""",
    "repeated_steps": f"""
        SELECT {STEP_KEYS}, count(*) AS rows FROM silver GROUP BY {STEP_KEYS}
        HAVING count(*) > 1""",
    "best_row_by_priority": "SELECT * FROM best_airlines",
    "first_row_per_key": "SELECT * FROM first_aerodromes",
    "first_line_per_order": """
        SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""",
    "code_lookup_fallback": """
        SELECT di_code, di_description, line_type_code, line_type_description,
          count(*) AS flight_steps
        FROM (SELECT s.di_code, s.line_type_code,
                coalesce(d.description, 'Codigo nao catalogado (' || s.di_code || ')')
                  AS di_description,
                coalesce(t.description, 'Codigo nao catalogado (' || s.line_type_code || ')')
                  AS line_type_description
              FROM silver s
              LEFT JOIN codes d ON d.domain = 'di_code' AND d.code = s.di_code
              LEFT JOIN codes t ON t.domain = 'line_type_code' AND t.code = s.line_type_code)
        GROUP BY ALL""",
    "union_distinct_codes": "SELECT * FROM airport_codes",
    "role_playing_nation": """
        SELECT b.n_name AS buyer_nation, s.n_name AS seller_nation, count(*) AS lines,
          CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation b ON c_nationkey = b.n_nationkey
        LEFT JOIN nation s ON s_nationkey = s.n_nationkey
        GROUP BY ALL""",
    "anti_join_not_in": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders
                          WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "not_in_plain": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE c_custkey NOT IN
          (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "anti_join_null_aware": """
        WITH buyers AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS buyer
                        FROM orders WHERE o_orderpriority = '1-URGENT')
        SELECT 'not in' AS table_name, count(*) AS rows FROM customer
        WHERE c_custkey NOT IN (SELECT buyer FROM buyers)
        UNION ALL
        SELECT 'without match', count(*) FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM buyers WHERE buyer = c_custkey)""",
    "dim_airport": "SELECT * FROM airports",
    "distinct_airports": "SELECT count(DISTINCT icao_airport) AS airports FROM airports",
    "fact_flights": "SELECT * FROM fact",
    "fact_by_arrivals": "SELECT * FROM fact",
    "fact_after_month_refresh": "SELECT * FROM fact",
    "obt_flights": "SELECT * FROM obt",
    "row_chain": """
        SELECT step, rows_before, rows_after, rows_before - rows_after AS difference, target,
          'OK' AS verdict
        FROM (SELECT 'bronze -> silver' AS step, (SELECT count(*) FROM bronze) AS rows_before,
                     (SELECT count(*) FROM silver) AS rows_after, CAST(0 AS BIGINT) AS target
              UNION ALL SELECT 'silver -> fact', (SELECT count(*) FROM silver),
                     (SELECT count(*) FROM fact), NULL
              UNION ALL SELECT 'fact -> obt', (SELECT count(*) FROM fact),
                     (SELECT count(*) FROM obt), 0)""",
    "clustered_month_of_airline": f"""
        SELECT {STEP_KEYS}, airline_name, departure_punctual, route_icao FROM obt
        WHERE reference_month = DATE '1995-03-01' AND icao_airline = 'A007'""",
    "layer_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {view}" for name, view in [
            ("silver.vra", "silver"), ("silver.airlines", "airlines"),
            ("silver.aerodromes", "aerodromes"), ("gold.dim_airport", "airports"),
            ("gold.fact_flights", "fact"), ("gold.obt_flights", "obt")]),
    "q1_punctuality": """
        SELECT airline_name, count(*) AS flights, round(avg(departure_delay_min), 6) AS avg_dep_delay,
          round(avg(arrival_delay_min), 6) AS avg_arr_delay,
          count(*) FILTER (departure_punctual)::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE
            AS dep_on_time_pct
        FROM obt WHERE flight_status = 'REALIZADO' GROUP BY airline_name""",
    "q1b_judgeable_only": """
        SELECT airline_name, count(*) AS flights, round(avg(departure_delay_min), 6) AS avg_dep_delay,
          round(avg(arrival_delay_min), 6) AS avg_arr_delay,
          CASE WHEN count(departure_punctual) > 0
               THEN count(*) FILTER (departure_punctual)::DOUBLE * 100.0::DOUBLE
                    / count(departure_punctual)::DOUBLE END AS dep_on_time_pct
        FROM obt WHERE flight_status = 'REALIZADO' GROUP BY airline_name""",
    "q2_routes": """
        SELECT route_municipalities, count(*) AS flights,
          round(avg(minutes_recovered), 6) AS avg_minutes_recovered
        FROM obt WHERE flight_status = 'REALIZADO' GROUP BY route_municipalities
        ORDER BY flights DESC, route_municipalities LIMIT 10""",
    "q3_cancellation": """
        SELECT airline_name, count(*) AS flights,
          CAST(sum(CAST(flight_cancelled AS INT)) AS BIGINT) AS cancelled,
          sum(CAST(flight_cancelled AS INT))::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE
            AS cancel_pct
        FROM obt GROUP BY airline_name ORDER BY cancelled DESC, airline_name LIMIT 10""",
    "q4_monthly": """
        SELECT reference_month, flight_status, count(*) AS flights,
          round(avg(arrival_delay_min), 6) AS avg_delay
        FROM obt GROUP BY reference_month, flight_status""",
    "q5_hourly": """
        SELECT scheduled_departure_hour, round(avg(departure_delay_min), 6) AS avg_dep_delay,
          round(avg(arrival_delay_min), 6) AS avg_arr_delay, count(*) AS flights
        FROM obt WHERE flight_status = 'REALIZADO' AND departure_delay_min IS NOT NULL
        GROUP BY scheduled_departure_hour""",
    "n1_city_delays": """
        SELECT airline_name, count(*) AS flights,
          count(*) FILTER (NOT departure_punctual) AS late_departures
        FROM obt WHERE origin_municipality LIKE '%Cidade NATION_2%' GROUP BY airline_name""",
    "n2_route_cancellation": """
        SELECT route_icao, count(*) AS flights, count(*) FILTER (flight_cancelled) AS cancelled,
          sum(CAST(flight_cancelled AS INT))::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE
            AS cancel_pct
        FROM obt GROUP BY route_icao""",
    "n3_monthly_recovery": """
        SELECT reference_month, round(avg(minutes_recovered), 6) AS avg_minutes_recovered
        FROM obt GROUP BY reference_month""",
    "n4_foreign_cancellations": """
        SELECT airline_name, count(*) AS cancelled FROM fact
        WHERE airline_registry = 'foreign' AND flight_cancelled GROUP BY airline_name""",
    "delimited_round_trip": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
          CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment,
          CAST(c_custkey % 7 AS VARCHAR) AS from_file FROM customer""",
    "rejected_lines": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
          CASE WHEN c_custkey % 10 = 5 THEN c_name || ';x'
               WHEN c_custkey % 10 NOT IN (1, 2, 3, 4) THEN c_name END AS c_name,
          CASE c_custkey % 10 WHEN 1 THEN 'too few fields' WHEN 2 THEN 'too many fields'
               WHEN 3 THEN 'unbalanced quotes' WHEN 4 THEN 'unbalanced quotes' END AS reason,
          CASE c_custkey % 10
               WHEN 1 THEN concat_ws(';', c_custkey, c_name, c_nationkey)
               WHEN 2 THEN concat_ws(';', c_custkey, c_name, c_nationkey, c_mktsegment, 'more')
               WHEN 3 THEN concat_ws(';', c_custkey, '"' || c_name, c_nationkey, c_mktsegment)
               WHEN 4 THEN concat_ws(';', c_custkey, c_name, c_nationkey, '"' || c_mktsegment)
          END AS line
        FROM customer""",
    "registry_scan": """
        SELECT nullif(icao, '') AS icao, iata_code, legal_name, service, city, state, status,
          CASE registry_origin WHEN 'national' THEN 'pda_empresas_aereas_nacionais.csv'
               ELSE 'pda_empresas_aereas_estrangeiros.csv' END AS _arquivo_origem
        FROM airlines""",
    "loads_of_new_files": """
        SELECT CAST(load_id AS INT) AS load_id, CAST(files AS INT) AS files, rows FROM (
          SELECT 1 AS load_id, count(DISTINCT c_custkey % 7) AS files, count(*) AS rows
          FROM customer WHERE c_custkey % 7 < 5
          UNION ALL SELECT 2, 0, 0
          UNION ALL SELECT 3, count(DISTINCT c_custkey % 7), count(*)
          FROM customer WHERE c_custkey % 7 >= 5)""",
    "counts_from_footers": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}"
        for name in ("customer", "orders", "lineitem", "documents", "events")),
    "latin1_round_trip": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(line) AS text_md5,
          CAST(length(line) AS INTEGER) AS chars
        FROM (SELECT doc_id, '"' || left(lang, 1) || ' ' || trim(regexp_replace(
                regexp_replace(text, '[;\\s]+', ' ', 'g'), '[^\\x20-\\x7E\\x{A1}-\\x{FF}]', '?', 'g'))
                AS line FROM documents)""",
    "n5_worst_hour": """
        SELECT scheduled_departure_hour, round(avg(departure_delay_min), 6) AS avg_dep_delay,
          count(*) AS flights
        FROM obt WHERE departure_delay_min IS NOT NULL GROUP BY scheduled_departure_hour
        ORDER BY avg(departure_delay_min) DESC, scheduled_departure_hour LIMIT 1""",
    "flights_by_status": """
        SELECT flight_status, count(*) AS flights FROM obt GROUP BY flight_status""",
    "delay_recovery": """
        SELECT count(*) AS recovered_some_minutes,
          count(*) FILTER (arrival_delay_min <= 0) AS arrived_early_or_on_time,
          count(*) FILTER (arrival_delay_min > 0) AS arrived_late_anyway,
          count(*) FILTER (arrival_delay_min > 15) AS arrived_late_over_15
        FROM obt WHERE minutes_recovered > 0""",
    "punctual_null_by_status": """
        SELECT flight_status, count(*) AS flights,
          count(*) - count(departure_punctual) AS departure_punctual_null
        FROM obt GROUP BY flight_status""",
    "carrier_skew": """
        WITH counts AS (SELECT icao_airline AS key, count(*) AS n FROM fact GROUP BY icao_airline),
             leaders AS (SELECT key FROM counts ORDER BY n DESC, key LIMIT 3)
        SELECT CASE WHEN key IN (SELECT key FROM leaders) THEN key ELSE 'others' END AS key,
          CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys,
          sum(n)::DOUBLE * 100.0::DOUBLE / (SELECT count(*) FROM fact)::DOUBLE AS pct_of_rows
        FROM counts GROUP BY 1""",
    "supplier_skew": """
        WITH counts AS (SELECT CAST(l_suppkey AS VARCHAR) AS key, count(*) AS n
                        FROM lineitem GROUP BY 1),
             leaders AS (SELECT key FROM counts ORDER BY n DESC, key LIMIT 3)
        SELECT CASE WHEN key IN (SELECT key FROM leaders) THEN key ELSE 'others' END AS key,
          CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys,
          sum(n)::DOUBLE * 100.0::DOUBLE / (SELECT count(*) FROM lineitem)::DOUBLE AS pct_of_rows
        FROM counts GROUP BY 1""",
    "monthly_extremes": """
        WITH months AS (SELECT reference_month AS g, count(*) AS n FROM fact
                        WHERE reference_month IS NOT NULL GROUP BY 1)
        SELECT (SELECT g FROM months ORDER BY n, g LIMIT 1) AS smallest,
          (SELECT min(n) FROM months) AS smallest_rows,
          (SELECT g FROM months ORDER BY n DESC, g DESC LIMIT 1) AS largest,
          (SELECT max(n) FROM months) AS largest_rows,
          (SELECT count(*) FROM months) AS groups""",
    "doc_coverage": """
        SELECT source, lang, count(*) AS total,
          count(*) FILTER (NOT labelled) AS missing,
          round(count(*) FILTER (labelled)::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE, 1)
            AS pct_covered
        FROM (SELECT source, lang, doc_id IN (SELECT doc_id FROM labels) AS labelled
              FROM documents)
        GROUP BY source, lang""",
    "tag_missing": """
        SELECT doc_id, source, lang FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "tag_listing": """
        SELECT 'quality' AS tag_name, CAST(quality AS VARCHAR) AS tag_value, count(*) AS documents
        FROM labels GROUP BY 2
        UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), count(*) FROM labels GROUP BY 2""",
    "lineage_edges": """
        SELECT DISTINCT CASE WHEN event_type = 'error' THEN '(file)' ELSE event_type END AS source,
          'lake.user_' || CAST(user_id AS VARCHAR) AS target
        FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-24'""",
    "snapshot_compare": """
        SELECT 'version 0' AS snapshot, count(*) AS rows, min(o_orderdate) AS first_stamp
        FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
        UNION ALL SELECT 'current', count(*), min(o_orderdate) FROM orders""",
    "load_ledger": """
        SELECT CAST(0 AS INT) AS version, 'overwrite' AS operation, count(*) AS rows_written
        FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
        UNION ALL SELECT 1, 'overwrite', count(*) FROM orders""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    for word in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)|,\s*(\w+)\)", sql):
        view = word[0] or word[1]
        if view in VIEWS and view not in found:
            _needed(VIEWS[view], found)
            found[view] = None


def sql_for(name: str) -> str:
    """One self-contained statement: the needed views, then the query."""
    found: dict[str, None] = {}
    _needed(QUERIES[name], found)
    views = ", ".join(f"fx_{view} AS ({VIEWS[view]})" for view in found)
    return _prefixed(f"WITH {views} SELECT * FROM ({QUERIES[name]})" if found else QUERIES[name],
                     found)


def _prefixed(sql: str, views: dict[str, None]) -> str:
    for view in views:
        sql = re.sub(rf"\b(FROM|JOIN)(\s+){view}\b", rf"\1\2fx_{view}", sql)
        sql = re.sub(rf"\bFROM fx_judged, {view}\b", f"FROM fx_judged, fx_{view}", sql)
    return sql
