"""Golden set for name mapping: the 100 master names and the 23 annotated
dirty names with their expected master (None = not in the master list).

Fixed values, in their original order.
"""

MASTERS = [
    "SAP",
    "Microsoft Teams",
    "Zoom",
    "Slack",
    "Salesforce",
    "Oracle Database",
    "ServiceNow",
    "Workday",
    "Adobe Creative Cloud",
    "Atlassian Jira",
    "Confluence",
    "GitHub",
    "GitLab",
    "Jenkins",
    "Docker",
    "Kubernetes",
    "AWS",
    "Microsoft Azure",
    "Google Cloud Platform",
    "Snowflake",
    "Tableau",
    "Power BI",
    "Looker",
    "Databricks",
    "Splunk",
    "Datadog",
    "New Relic",
    "PagerDuty",
    "Okta",
    "Duo Security",
    "CrowdStrike",
    "Palo Alto Networks",
    "Zscaler",
    "Fortinet",
    "Cisco Webex",
    "Microsoft Outlook",
    "Google Workspace",
    "Dropbox Business",
    "Box",
    "OneDrive",
    "SharePoint",
    "Trello",
    "Asana",
    "Monday.com",
    "Notion",
    "Airtable",
    "HubSpot",
    "Marketo",
    "Mailchimp",
    "Zendesk",
    "Freshdesk",
    "Intercom",
    "Twilio",
    "SendGrid",
    "Stripe",
    "PayPal",
    "Square",
    "QuickBooks",
    "NetSuite",
    "Xero",
    "Concur",
    "Expensify",
    "Coupa",
    "Ariba",
    "DocuSign",
    "Adobe Sign",
    "PandaDoc",
    "HelloSign",
    "Miro",
    "Figma",
    "Sketch",
    "InVision",
    "Canva",
    "Photoshop",
    "Illustrator",
    "Premiere Pro",
    "Final Cut Pro",
    "AutoCAD",
    "SolidWorks",
    "MATLAB",
    "Anaconda",
    "Visual Studio Code",
    "IntelliJ IDEA",
    "Eclipse",
    "PyCharm",
    "Postman",
    "Insomnia",
    "Terraform",
    "Ansible",
    "Puppet",
    "Chef",
    "Nagios",
    "Prometheus",
    "Grafana",
    "Elasticsearch",
    "MongoDB",
    "Redis",
    "PostgreSQL",
    "MySQL",
    "Microsoft SQL Server",
]

DIRTY = [
    ("sap", "SAP"),
    ("MS Teams", "Microsoft Teams"),
    ("ZOOM", "Zoom"),
    ("slack", "Slack"),
    ("Sales Force", "Salesforce"),
    ("Oracle DB", "Oracle Database"),
    ("Service Now", "ServiceNow"),
    ("Work Day", "Workday"),
    ("Adobe CC", "Adobe Creative Cloud"),
    ("JIRA", "Atlassian Jira"),
    ("git hub", "GitHub"),
    ("AWS Amazon", "AWS"),
    ("Azure", "Microsoft Azure"),
    ("GCP", "Google Cloud Platform"),
    ("snow flake", "Snowflake"),
    ("TABLEAU", "Tableau"),
    ("PowerBI", "Power BI"),
    ("Cisco WebEx", "Cisco Webex"),
    ("MS Outlook", "Microsoft Outlook"),
    ("quick books", "QuickBooks"),
    ("Linear", None),
    ("Basecamp", None),
    ("Clockify", None),
]
