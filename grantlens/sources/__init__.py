"""Reading and writing: delimited files, warehouse tables, reports, manifests, generated data."""
