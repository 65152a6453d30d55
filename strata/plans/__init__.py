"""Test-table fixtures, the batch and producer jobs, the query catalog and the SQL oracle."""
