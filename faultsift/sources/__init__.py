"""Tables read and written: investigations, payloads, endpoints, ledger, drafts."""
