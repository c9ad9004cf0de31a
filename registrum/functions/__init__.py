"""Column expressions that clean the fields of company and e-mail records."""
