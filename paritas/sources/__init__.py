"""Reading tables, catalogs and control tables; writing results."""
