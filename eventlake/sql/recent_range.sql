-- The recent run as one script: the range's days of the typed table are replaced
-- by the batch, and the deduplicated table's by the newest copies of them.
-- Parameters: typed, deduped (table names), start_date, end_date; {batch} are the
-- typed rows of the range's day files. Tables are partitioned by source_day; an
-- overwrite of a partitioned table is set to replace the days that it names.
DECLARE lo DATE DEFAULT CAST(:start_date AS DATE);
DECLARE hi DATE DEFAULT CAST(:end_date AS DATE);

INSERT OVERWRITE TABLE IDENTIFIER(:typed)
SELECT * FROM {batch} WHERE source_day BETWEEN lo AND hi;

INSERT OVERWRITE TABLE IDENTIFIER(:deduped)
SELECT * EXCEPT (place) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY request_id, funnel_id, session_id, page_name, `timestamp`
    ORDER BY ingested_at DESC NULLS LAST, source_day DESC NULLS LAST, source_file DESC NULLS LAST) AS place
  FROM IDENTIFIER(:typed) WHERE source_day BETWEEN lo AND hi)
WHERE place = 1;

SELECT source_day, count(*) AS events FROM IDENTIFIER(:deduped)
WHERE source_day BETWEEN lo AND hi GROUP BY source_day;
