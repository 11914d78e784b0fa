"""Pure DataFrame operators: staging, positions, risk, cashflow, regulatory reports, DQ rules, checks, publishing."""
