-- The winner among the copies of each event in the file days
-- :start_date to :end_date (DATE) of {typed}: latest load, then latest file
-- day, then file name. max_by carries whole rows, so no column is listed.
WITH copies AS (
  SELECT struct(d.*) AS whole, d.*
  FROM {typed} AS d
  WHERE d.source_day >= :start_date AND d.source_day <= :end_date
),
winners AS (
  SELECT max_by(whole, struct(ingested_at, source_day, source_file)) AS whole
  FROM copies
  GROUP BY request_id, funnel_id, session_id, page_name, `timestamp`
)
SELECT whole.* FROM winners
