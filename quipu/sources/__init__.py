"""Where rows come from: ERP tables, JDBC, landed CSV files, the catalog."""
