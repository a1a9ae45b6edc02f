SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate
FROM {facts}
WHERE date(l_shipdate) >= :start_date
  AND date(l_shipdate) < :end_date
  AND array_contains(:ids, l_quantity)
