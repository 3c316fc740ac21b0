"""Import-declaration processing on PySpark: scan, normalise, translate, dedup-append, report."""
