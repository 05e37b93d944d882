"""Dataset plans (news, air, census), registered queries and their SQL oracles."""
