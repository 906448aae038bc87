"""Rule catalogues, the audit run and the registered queries."""
