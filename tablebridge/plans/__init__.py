"""Jobs composed of several operators: copies, migrations, reports."""
