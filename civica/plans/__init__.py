"""Jobs composed from the operators: reconcile, KPIs, sheets, model, batch."""
